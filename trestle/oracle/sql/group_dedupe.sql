select proj_id, task_id, short_name from fx_task_tag group by proj_id, task_id, short_name
