with month as (        -- one row per job and month with the running cost totals of all its phases
  select jcco, job, month_date as mth, cast(sum(cumulative_actual_cost) as double) as spent,
    cast(sum(cumulative_projected) as double) as projected
  from q_job_cost_monthly group by all
), granted as (        -- contract amount up to each month that the job has: every change not later than it
  select m.jcco, m.job, m.mth, sum(k.amount) as amount
  from month m join (select jcco, contract as job, change_month, sum(contract_amt) as amount from q_contract_changes group by all) k
    on k.jcco = m.jcco and k.job = m.job and k.change_month <= m.mth
  where exists (from month o where o.jcco = m.jcco and o.job = m.job and o.mth = k.change_month)
  group by all
), override as (
  select jcco, contract as job, mth, nullif(sum(proj_revenue), 0) as revenue, nullif(sum(proj_over_cost), 0) as cost, nullif(sum(actual_cost), 0) as actual
  from fx_override group by all
), restated as (       -- overrides of the actual cost add up over the months that the job has
  select m.jcco, m.job, m.mth, cast(sum(o.actual) as double) as spent
  from month m join override o on o.jcco = m.jcco and o.job = m.job and o.mth <= m.mth
  where exists (from month x where x.jcco = m.jcco and x.job = m.job and x.mth = o.mth) group by all
)
select jcco, job, mth, tj_contract_amount, cast(tj_cost as bigint) as tj_cost, tj_margin, round(margin_share, 6) as tj_margin_pct,
  round(earned + spent, 2) as jtd_revenue, cast(spent as bigint) as jtd_cost, round(earned, 2) as jtd_margin,
  round(done, 6) as jtd_percent_complete, round(tj_contract_amount - (earned + spent), 2) as backlog_revenue,
  round(tj_margin - earned, 2) as backlog_margin
from (
  select m.jcco, m.job, m.mth, round(coalesce(r.spent, m.spent)) as spent, round(coalesce(cast(o.revenue as double), g.amount)) as tj_contract_amount,
    round(coalesce(cast(o.cost as double), m.projected)) as tj_cost, tj_contract_amount - tj_cost as tj_margin,
    if(tj_cost = 0, 0.0, round(coalesce(r.spent, m.spent)) / tj_cost) as done,
    if(tj_contract_amount = 0, 0.0, tj_margin / tj_contract_amount) as margin_share,
    if(tj_margin < 0, tj_margin, done * tj_margin) as earned     -- a loss counts in full at once
  from month m left join granted g using (jcco, job, mth) left join override o using (jcco, job, mth)
    left join restated r using (jcco, job, mth))
