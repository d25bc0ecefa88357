select b.gl_co, b.gl_account, a.part1 as natural_account, a.part2 as account_division, a.part3 as account_department,
  a.description as account_description, a.acct_type as account_type, d.description as department_description, b.budget_code,
  c.description as budget_description, split_part(b.budget_code, ' ', 1) as budget_year,
  nullif(regexp_extract(b.budget_code, 'FC([0-9.]+)', 1), '') as fc_number, b.mth, b.budget_cents
from fx_budget b
  left join fx_account a on (a.glco, a.glacct) = (b.gl_co, b.gl_account)
  left join fx_budget_code c on (c.glco, c.budget_code) = (b.gl_co, b.budget_code)
  left join fx_dept d on (trim(d.glco), trim(d.department)) = (trim(b.gl_co), trim(a.part2))
where b.mth >= date '1996-01-01' and try_cast(split_part(b.budget_code, ' ', 1) as int) >= 1996
