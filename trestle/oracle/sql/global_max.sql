select max(start_week) as latest_week from fx_task
