with tk as (select * from fx_task)
select l.proj_id, l.task_id, l.pred_task_id, l.pred_type, s.start_week, s.act_start_date, p.act_end_date as pred_act_end_date
from fx_task_pred l
join tk s on s.proj_id = l.proj_id and s.task_id = l.task_id
join tk p on p.proj_id = l.proj_id and p.task_id = l.pred_task_id and p.start_week = s.start_week
