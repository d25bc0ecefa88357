with line as (
  select part1, coalesce(arg_min(r.line, priority), '-') as line
  from (select distinct part1 from fx_gl) left join fx_rule_line r on starts_with(part1, prefix) group by part1
), entry as (
  select mth, netamt_cents as amount,
    if(line = '-' and coalesce(try_cast(part1 as int), 0) between 11000 and 11199 and part1 not in ('11150', '11170')
       and glco not in ('132', '134'), 'cash', if(line = '-', 'other', line)) as line
  from fx_gl join line using (part1) anti join fx_excluded_company using (glco) where mth >= date '1997-01-01'
)
select mth, cast(-coalesce(sum(amount) filter (line = 'construction_revenue'), 0) as bigint) as revenue_cents,
  cast(coalesce(sum(amount) filter (line = 'direct_construction_cost'), 0) as bigint) as direct_cost_cents,
  cast(coalesce(sum(amount) filter (line = 'indirect_construction_cost'), 0) as bigint) as indirect_cost_cents,
  cast(coalesce(sum(amount) filter (line = 'admin_expenses'), 0) as bigint) as admin_cents,
  cast(coalesce(sum(amount) filter (line = 'cash'), 0) as bigint) as cash_cents,
  cast(coalesce(sum(amount) filter (line = 'other'), 0) as bigint) as other_cents
from entry group by mth
