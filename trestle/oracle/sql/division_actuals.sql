with g as (select * from q_gl_account_summary where lower(department_description) like '%region%'),
acct as (
  select gl_co, gl_account, natural_account, account_division, account_department, department_description, mth,
    sum(try_cast(net_amount as double)) as net_amount
  from g group by all
), rev as (
  select gl_co, gl_account, natural_account, account_division, account_department, department_description, mth, sum(net_amount) as revenue
  from acct where natural_account like '41010%' group by all
), mg as (
  select gl_co, account_division, mth, sum(net_amount) as margin from acct group by all
)
select r.gl_co, r.account_division, lpad(left(r.account_division, 2) || '00', 4, '0') as region, right(r.account_division, 2) as division,
  r.department_description, r.mth, cast(round(r.revenue) as bigint) as revenue, cast(round(m.margin) as bigint) as margin
from rev r left join mg m on r.gl_co = m.gl_co and r.account_division = m.account_division and r.mth = m.mth
where r.account_division not like '%00' and r.mth >= '1997-01-01'
