select proj_id, week_ending,
  round(case when resources_to_date is null or next_week_resources is null then null
             when next_week_resources = 0 then 0.0 else resources_to_date / next_week_resources end, 6) as ratio,
  round(case when (case when total_float < 0 then null else resources_to_date end) is null then null
             else cast(0 as double) end, 6) as ratio_zero_div
from fx_weekly
