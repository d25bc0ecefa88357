select proj_id, task_id, start_week,
  case when total_float_hr_cnt / 8 > 15 then 'A'
       when total_float_hr_cnt / 8 between 0 and 15 then 'B'
       when total_float_hr_cnt / 8 between -10 and -1 then 'C'
       when total_float_hr_cnt / 8 between -20 and -11 then 'D'
       else 'F' end as float_grade
from fx_task
