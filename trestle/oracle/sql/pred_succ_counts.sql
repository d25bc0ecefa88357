with n as (select distinct proj_id, task_id from fx_task),
p as (select proj_id, task_id, count(distinct pred_task_id) as pred_count from fx_task_pred group by all),
s as (select proj_id, pred_task_id as task_id, count(distinct task_id) as succ_count from fx_task_pred group by all)
select n.proj_id, n.task_id, coalesce(p.pred_count, 0) as pred_count, coalesce(s.succ_count, 0) as succ_count
from n left join p using (proj_id, task_id) left join s using (proj_id, task_id)
