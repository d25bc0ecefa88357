with area as (         -- four areas, each with its four divisions and itself
  select format('{:02d}{}0', a, d) as account_division from (select unnest([4, 6, 8, 12]) as a), generate_series(0, 4) as g(d)
),
named as (             -- plan lines carry the month's year, forecast lines the code's year and rounded number
  select *, cast(extract(year from mth) as int) as mth_year,
    if(try_cast(budget_year as int) <> extract(year from mth), 'Plan', if(fc_number is not null, 'FC', null)) as budget_type,
    if(budget_type = 'Plan', format('{} Plan', mth_year), format('{} FC{}', budget_year, cast(round(try_cast(fc_number as double)) as bigint))) as budget_name
  from q_budget_parsed semi join area using (account_division)
), chosen as (
  select * from (
    select distinct on (gl_account, mth) * from named where budget_type = 'Plan'
    order by gl_account, mth, fc_number desc nulls first, gl_co, budget_code, budget_cents)
  union all by name
  select * exclude newest from (
    select *, max(fc_number) over (partition by budget_name, floor(cast(fc_number as double))) as newest
    from named where budget_type = 'FC')
  where fc_number = newest
)
select gl_co, account_division, left(account_division, 2) || '00' as region, right(account_division, 2) as division,
  department_description, budget_name, mth_year, mth, revenue, margin
from (
  select gl_co, account_division, department_description, budget_name, mth_year, mth,
    cast(sum(budget_cents) as bigint) as margin
  from chosen group by all)
join (
  select gl_co, account_division, budget_name, mth, budget_cents as revenue from chosen where natural_account = '41010'
) using (gl_co, account_division, budget_name, mth)
where right(account_division, 2) <> '00'
