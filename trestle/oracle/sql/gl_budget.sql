with
named as (             -- plan lines carry the month's year, forecast lines the code's year and rounded number
  select *, cast(extract(year from mth) as int) as mth_year,
    if(try_cast(budget_year as int) <> extract(year from mth), 'Plan', if(fc_number is not null, 'FC', null)) as budget_type,
    if(budget_type = 'Plan', format('{} Plan', mth_year), format('{} FC{}', budget_year, cast(round(try_cast(fc_number as double)) as bigint))) as budget_name
  from q_budget_parsed
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
select gl_co, gl_account, mth, natural_account, account_division, account_department, department_description, budget_code,
  budget_year, fc_number, budget_cents, budget_name, mth_year, budget_type,
  coalesce(try_cast(account_division as int), if(account_division = '', 0, null)) as account_division_number,
  coalesce(line, 'other') as pl_line_item, cast(gl_co not in (from fx_excluded_company) as int) as include_company,
  cast(coalesce(pl_line_item = 'indirect_construction_cost' and (try_cast(budget_year as int) < 1999
       or account_division in ('0000', '3000', '0400', '0600', '0800', '1200')), false) as int) as use_indirect_cost,
  rm.region, rm.market, coalesce(rm.region, 'Other') as region_clean, coalesce(rm.market, 'Other') as market_clean,
  region_clean || ' - ' || market_clean as region_market_clean
from chosen
  left join (select gl_account, arg_min(line, priority) as line
             from (select distinct gl_account from q_budget_parsed) join fx_rule_line on starts_with(gl_account, prefix)
             group by gl_account) using (gl_account)
  left join q_dim_region_market rm on rm.department = account_division
