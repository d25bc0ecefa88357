select task_type, start_week, count(*) as n from fx_task group by task_type, start_week
