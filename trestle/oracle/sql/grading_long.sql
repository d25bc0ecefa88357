with metric as (       -- fixed values: order, type and display name of the metrics
  select * from (values
    (1, 'long_duration', 'architecture', 'Long Duration (%)'), (2, 'high_float', 'architecture', 'High Float (%)'),
    (3, 'missing_logic', 'architecture', 'Missing Logic (#)'), (4, 'fs_relationships', 'architecture', 'FS Relationship (%)'),
    (5, 'lags', 'architecture', 'Lags (%)'), (6, 'leads', 'architecture', 'Leads (%)'),
    (7, 'hard_constraints', 'architecture', 'Hard Constraints (#)'), (8, 'soft_constraints', 'architecture', 'Soft Constraints (%)'),
    (9, 'invalid_dates', 'architecture', 'Invalid Dates (#)'),
    (10, 'out_of_sequence', 'architecture', 'Out of Sequence Activities (%)'),
    (11, 'bei', 'performance', 'Baseline Execution Index (BEI)'), (12, 'cpli', 'performance', 'Critical Path Length Index (CPLI)'),
    (13, 'tfci', 'performance', 'Total Float Consumption Index (TFCI)'), (14, 'total_float_days', 'performance', 'Total Float Days (#)'),
    (15, 'resource_look_ahead', 'performance', 'Resource Lookahead (%)'), (16, 'missed_activities', 'performance', 'Missed Activities (%)')
  ) as m(metric_order, metric_name, metric_type, metric_full_name)
), graded as (         -- every metric query gives its (name, value, grade) pairs
  from q_sched_constraints select proj_id, start_week, unnest([
    {n: 'hard_constraints', v: cast(num_hard_consts as double), g: hard_consts_grade},
    {n: 'soft_constraints', v: pct_soft_consts, g: soft_consts_grade},
    {n: 'invalid_dates', v: cast(num_invalid_dates as double), g: invalid_date_grade}]) as x
  union all from q_sched_float select proj_id, start_week, unnest([
    {n: 'high_float', v: cast(pct_high_float as double), g: high_float_grade}, {n: 'tfci', v: tfci, g: tfci_grade},
    {n: 'total_float_days', v: total_float_days, g: negative_float_grade}, {n: 'cpli', v: cpli, g: cpli_grade}])
  union all from q_sched_lag_lead select proj_id, start_week, unnest([
    {n: 'lags', v: cast(lags_pct as double), g: lags_grade}, {n: 'leads', v: leads_pct, g: leads_grade}])
  union all from q_sched_baseline select proj_id, start_week, unnest([
    {n: 'bei', v: cast(bei as double), g: bei_grade}, {n: 'missed_activities', v: missed_pct, g: miss_act_grade}])
  union all from q_sched_missing_logic select proj_id, start_week,
    {n: 'missing_logic', v: cast(total_missing_logic_cnt as double), g: missing_logic_grade}
  union all from q_sched_relationships select proj_id, start_week, {n: 'fs_relationships', v: cast(fs_pct as double), g: fs_grade}
  union all from q_sched_out_of_sequence select proj_id, start_week, {n: 'out_of_sequence', v: cast(out_seq_pct as double), g: out_seq_grade}
  union all from q_sched_resource_look_ahead select proj_id, start_week,
    {n: 'resource_look_ahead', v: cast(resource_look_ahead_pct as double), g: resource_look_ahead_grade}
  union all from q_sched_high_duration select proj_id, start_week, {n: 'long_duration', v: cast(long_dur_pct as double), g: dur_grade}
)
select cast(k.proj_id as varchar) as proj_id, k.proj_name, k.start_week, m.metric_name, round(x.v, 6) as metric_value,
  cast(x.g as varchar) as metric_grade, m.metric_order, m.metric_type, m.metric_full_name,
  cast(nullif(position(metric_grade in 'FDCBA'), 0) - 1 as int) as grade_points,
  cast(grade_points * if(m.metric_name in ('bei', 'tfci', 'total_float_days'), 0.25, 1.0) as double) as adj_grade_points
from q_sched_constraints k cross join metric m
  left join graded on graded.proj_id = k.proj_id and graded.start_week = k.start_week and x.n = m.metric_name
