with clock as (        -- load times, also as seen from the report's zone, and the newest file of the control table
  select min(ts) filter (event_type <> 'error') as first_ok, max(ts) filter (event_type <> 'error') as last_ok,
    max(ts) as last_any, (timestamp '2001-08-01' at time zone 'America/Los_Angeles') at time zone 'America/New_York' as now,
    (select max_by({day: cast(file_month_year as date), loaded: cast(file_month_year as timestamp) + to_days(load_no)}, file_month_year)
     from fx_control where active) as file
  from events
), newest_forecast as (
  select max_by(budget_name, (mth_year, fc_number)) as budget_name from q_gl_budget where budget_type = 'FC'
)
select x.n as data_source, x.d as data_date_ref, x.l as last_load_dt
from (select unnest([
  {n: 'New Sales', d: file.day, l: file.loaded}, {n: 'WIP', d: file.day, l: file.loaded},
  {n: 'Rolling Forecast', d: file.day, l: file.loaded}, {n: 'Pending Backlog', d: file.day, l: file.loaded},
  {n: 'KPA', d: (select if(count(*) > count(injury_date), null, cast(max(injury_date) as date)) from q_incident_month),
   l: (last_ok at time zone 'America/Los_Angeles') at time zone 'America/New_York'},
  {n: 'GL Actuals', d: (select max(actual_date) from q_cost_nonzero where actual_date <= date '2001-08-01'),
   l: (last_any at time zone 'America/Los_Angeles') at time zone 'America/New_York'},
  {n: 'GL Budget', d: (select min(mth) from q_gl_budget semi join newest_forecast using (budget_name) where budget_type = 'FC'),
   l: (last_any at time zone 'America/Los_Angeles') at time zone 'America/New_York'},
  {n: 'power_bi_refresh', d: cast(now as date), l: now}]) as x from clock)
