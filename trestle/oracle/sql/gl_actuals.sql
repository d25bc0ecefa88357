with account as (      -- the P&L line of every account number, by the first rule that fits
  select part1, arg_min(line, priority) as line
  from (select distinct part1 from fx_gl) join fx_rule_line on starts_with(part1, prefix) group by part1
), name as (           -- one name list for the three segments
  select distinct partno, trim(glco) as co, trim(instance) as code, trim(description) as label from fx_segment
), dept as (
  select distinct trim(glco) as co, trim(department) as code, trim(description) as label from fx_dept
), entry as (
  select trim(glco) as co, part1, part2, part3, mth, netamt_cents, try_cast(part1 as int) as account_no
  from fx_gl where mth >= date '1997-01-01'
)
select e.co as glco, concat_ws('.', e.part1, e.part2, e.part3) as glacct, ac.description as account_description, ac.acct_type as account_type, mth, netamt_cents, e.part1 as natural_account,
  e.part2 as account_division, e.part3 as account_department, n1.label as natural_account_desc,
  coalesce(dept.label, n2.label) as division_description, n3.label as department_description,
  coalesce(try_cast(e.part2 as int), if(e.part2 = '', 0, null)) as account_division_number,
  coalesce(account_no, if(e.part1 = '', 0, null)) as natural_account_number,
  coalesce(account.line, if(coalesce(account_no, 0) between 11000 and 11199 and not list_contains([11150, 11170], account_no)
                            and not list_contains(['132', '134'], e.co), 'cash', 'other')) as pl_line_item,
  cast(e.co not in (from fx_excluded_company) as int) as include_company, rm.region, rm.market,
  cast(pl_line_item = 'indirect_construction_cost'
       and (mth < date '1999-01-01' or e.part2 in ('0000', '3000', '0400', '0600', '0800', '1200')) as int) as use_indirect_cost,
  if(pl_line_item = 'admin_expenses', ra.category, null) as admin_expense_category,
  coalesce(rm.region, 'Other') as region_clean, coalesce(rm.market, 'Other') as market_clean,
  region_clean || ' - ' || market_clean as region_market_clean
from entry e
  left join account using (part1)
  left join fx_account ac on ac.glco = e.co and (ac.part1, ac.part2, ac.part3) = (e.part1, e.part2, e.part3) and ac.part3 <> ''
  left join dept on dept.co = e.co and dept.code = e.part2
  left join name n1 on n1.partno = 1 and n1.co = e.co and n1.code = e.part1
  left join name n2 on n2.partno = 2 and n2.co = e.co and n2.code = e.part2
  left join name n3 on n3.partno = 3 and n3.co = e.co and n3.code = e.part3
  left join q_dim_region_market rm on rm.department = e.part2
  left join fx_rule_admin ra on ra.area = e.part2 and ra.dept = e.part3
