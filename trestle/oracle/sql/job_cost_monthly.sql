with cost as (
  select trim(jcco) as jcco, trim(job) as job, cost_type, trim(phase_group) as phase_group, trim(phase) as phase, mth as month_date,
    trim(trans_type) as kind, est_cents, proj_cents, actual_cents, committed_cents
  from fx_job_cost
), life as (           -- the months from a job's first to its last posting, for jobs begun in the last eight years
  select jcco, job, unnest(generate_series(cast(min(month_date) as timestamp), cast(max(month_date) as timestamp), interval 1 month)) as at
  from cost where kind in ('OE', 'CO', 'PF') or actual_cents <> 0 or committed_cents <> 0
  group by jcco, job having min(month_date) >= date '1993-08-01'
), posted as (         -- all five measures from one pass
  select jcco, job, cost_type, phase_group, phase, month_date,
    sum(est_cents) filter (kind = 'OE') as oe, sum(est_cents) filter (kind = 'CO') as co, sum(proj_cents) filter (kind = 'PF') as pf,
    sum(actual_cents) as act, sum(committed_cents) as com
  from cost group by all
), grid as (
  select ph.*, cast(life.at as date) as month_date,
    cast(coalesce(oe, 0) as bigint) as original_est, cast(coalesce(oe, 0) + coalesce(co, 0) as bigint) as current_est,
    cast(coalesce(pf, 0) as bigint) as projected, cast(coalesce(act, 0) as bigint) as actual_cost, cast(coalesce(com, 0) as bigint) as committed_cost
  from (select distinct jcco, job, cost_type, phase_group, phase from cost) ph join life using (jcco, job)
    left join posted p on (p.jcco, p.job, p.cost_type, p.phase_group, p.phase, p.month_date)
      = (ph.jcco, ph.job, ph.cost_type, ph.phase_group, ph.phase, life.at)
)
select g.*, pn.name as phase_name, ct.name as cost_type_name, cost_type || ' - ' || ct.name as cost_type_description,
  phase || ' - ' || pn.name as phase_description, left(phase, 11) as phase_core, left(phase, 2) as division,
  cast(division not in ('80', '96', '97', '98') and round((cumulative_projected - cumulative_actual_cost) / 100) < 0 as int) as negative_ctc_indicator,
  cast(division not in ('80', '96', '97', '98') and cost_type in ('2', '3') and cumulative_committed_cost > 0
       and cumulative_projected > cumulative_actual_cost and cumulative_projected >= 1.05 * cumulative_committed_cost as int) as po_variance_opp_indicator,
  cast(division in ('96', '97', '98') and cumulative_projected < cumulative_actual_cost as int) as profit_at_risk_indicator,
  negative_ctc_indicator * (cumulative_projected - cumulative_actual_cost) as negative_ctc_value,
  po_variance_opp_indicator * (cumulative_projected - greatest(cumulative_committed_cost, cumulative_actual_cost)) as po_variance_opp_value,
  profit_at_risk_indicator * (cumulative_actual_cost - cumulative_projected) as profit_at_risk_value,
  map_extract_value(map {'900': 'Supplemental Conditions', '901': 'Internal Contract Contingency', '902': 'Economic Contingency',
    '903': 'Labor Goal', '904': 'Profit on Change Orders', '905': 'Profit on Bonds and Insurance', '906': 'Profit on Unit Prices',
    '907': 'Profit on Billable Rates', '908': 'Profit on SDI'},
    if(starts_with(phase, '801000.'), regexp_extract(phase_core, '[.]([0-9]+)[.]$', 1), null)) as profit_enhancers
from (
  select *, cast(sum(original_est) over upto as bigint) as cumulative_original_est, cast(sum(current_est) over upto as bigint) as cumulative_current_est,
    cast(sum(projected) over upto as bigint) as cumulative_projected, cast(sum(actual_cost) over upto as bigint) as cumulative_actual_cost,
    cast(sum(committed_cost) over upto as bigint) as cumulative_committed_cost
  from grid window upto as (partition by job, cost_type, phase_group, phase order by month_date, jcco rows unbounded preceding)) g
  left join (select trim(jcco) as jcco, trim(job) as job, trim(phase_group) as phase_group, trim(phase) as phase,
      any_value(description) as name from fx_phase_name group by 1, 2, 3, 4) pn using (jcco, job, phase_group, phase)
  left join fx_cost_type ct using (phase_group, cost_type)
