with d as (select distinct total_float_hr_cnt from fx_task)
select total_float_hr_cnt, cast(round(total_float_hr_cnt / 8) as int) % 7 as days_mod_7,
  cast(floor(cast(round(total_float_hr_cnt / 8) as int) / 7) as bigint) as weeks
from d
