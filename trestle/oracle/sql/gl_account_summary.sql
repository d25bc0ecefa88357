with name as (
  select partno, trim(glco) as co, trim(instance) as code, description as label from fx_segment
), entry as (
  select trim(glco) as gl_co, concat_ws('.', part1, part2, part3) as gl_account, * from fx_gl
)
select e.gl_co, e.gl_account, a.description as account_description, a.acct_type as account_type, e.part1 as natural_account,
  n1.label as natural_account_desc, e.part2 as account_division, coalesce(d.description, n2.label) as division_description,
  e.part3 as account_department, n3.label as department_description, cast(e.mth as varchar) as mth,
  cast(e.netamt_cents as varchar) as net_amount, trim(e.jrnl) as jrnl, trim(e.glref) as gl_ref, trim(e.sourceco) as source_co, trim(e.source) as source
from entry e
  join name n1 on n1.partno = 1 and n1.co = e.gl_co and n1.code = e.part1
  join name n3 on n3.partno = 3 and n3.co = e.gl_co and n3.code = e.part3
  left join name n2 on n2.partno = 2 and n2.co = e.gl_co and n2.code = e.part2
  left join fx_dept d on trim(d.glco) = e.gl_co and trim(d.department) = e.part2
  left join fx_account a on a.glco = e.gl_co and a.glacct = e.gl_account
