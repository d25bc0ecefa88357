select proj_id, week_ending, cast(resources_to_date as bigint) as resources_to_date,
  cast(lead(resources_to_date, 6) over (partition by proj_id order by week_ending desc nulls first) as bigint) as resources_6_back,
  cast(lead(resources_to_date, 1) over (partition by proj_id order by week_ending desc nulls first) as bigint) as resources_1_back
from fx_weekly
