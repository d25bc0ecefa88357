with posting as (
  select mth, cast(sum(netamt_cents) filter (starts_with(glacct, '41010')) as bigint) as contract_revenue,
    cast(sum(netamt_cents) filter (starts_with(glacct, '41030')) as bigint) as overbillings_adjusted,
    cast(sum(netamt_cents) filter (pl_line_item = 'direct_construction_cost') as bigint) as cost
  from q_gl_actuals where glco = '136' group by mth
), life as (
  select unnest(generate_series(cast(min(mth) as timestamp), cast(max(mth) as timestamp), interval 1 month)) as t
  from posting having min(mth) >= date '1993-08-01'
)
select '136' as glco, cast(t as date) as mth, m.contract_revenue, m.overbillings_adjusted, m.cost,
  (select cast(sum(contract_revenue) as bigint) from posting where mth <= t) as cumulative_contract_revenue,
  (select cast(sum(overbillings_adjusted) as bigint) from posting where mth <= t) as cumulative_overbillings_adjusted,
  (select cast(sum(cost) as bigint) from posting where mth <= t) as cumulative_cost
from life left join posting m on m.mth = t
