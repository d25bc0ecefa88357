with a as (
  select mth,
    -1 * sum(case when pl_line_item = 'construction_revenue' and region is not null then netamt_cents else 0 end) as revenue,
    sum(case when pl_line_item = 'direct_construction_cost' and region is not null then netamt_cents else 0 end) as direct_cost,
    sum(case when pl_line_item = 'indirect_construction_cost' and use_indirect_cost = 1 then netamt_cents else 0 end) as indirect_cost
  from q_gl_actuals where include_company = 1 and year(mth) >= 1999 group by mth
), b as (
  select mth, budget_type, budget_name, fc_number, mth_year,
    -1 * sum(case when pl_line_item = 'construction_revenue' and region is not null then budget_cents else 0 end) as revenue,
    sum(case when pl_line_item = 'direct_construction_cost' and region is not null then budget_cents else 0 end) as direct_cost,
    sum(case when pl_line_item = 'indirect_construction_cost' and use_indirect_cost = 1 then budget_cents else 0 end) as indirect_cost
  from q_gl_budget where include_company = 1 and mth_year >= 1999 group by mth, budget_type, budget_name, fc_number, mth_year
), u as (
  select mth, '1999' as rev_type, revenue, direct_cost, indirect_cost from a where year(mth) = 1999
  union all select mth, '2000', revenue, direct_cost, indirect_cost from a where year(mth) = 2000
  union all select mth, '2001 YTD', revenue, direct_cost, indirect_cost from a where year(mth) = 2001
  union all select * from (select mth, '2001 Plan', revenue, direct_cost, indirect_cost from b where mth_year = 2001 and budget_type = 'Plan'
                           qualify fc_number = max(fc_number) over ())
  union all select * from (select mth, '2002 Plan', revenue, direct_cost, indirect_cost from b where mth_year = 2002 and budget_type = 'Plan'
                           qualify fc_number = max(fc_number) over ())
  union all select mth, budget_name, revenue, direct_cost, indirect_cost from b where mth_year = 2001 and budget_type = 'FC'
)
select mth, rev_type, cast(revenue as bigint) as revenue, cast(direct_cost as bigint) as direct_cost, cast(indirect_cost as bigint) as indirect_cost,
  cast(revenue - direct_cost - indirect_cost as bigint) as margin
from u
