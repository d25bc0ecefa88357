select proj_id, task_id, task_type, start_week from fx_task
where start_week = (select max(start_week) from fx_task)
