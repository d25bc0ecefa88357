select c.proj_id, p.baseline_proj_id, c.task_id, c.task_code, c.start_week,
  b.task_id as baseline_task_id, b.target_end_date as baseline_target_end_date
from fx_task c join fx_project p on c.proj_id = p.proj_id
left join fx_task b on b.proj_id = p.baseline_proj_id and b.task_code = c.task_code and b.start_week = c.start_week
