select proj_id, task_id, start_week from fx_task join (
  select proj_id, max(start_week) as start_week from fx_task where proj_id >= 1000000000 group by proj_id
) using (proj_id, start_week)
