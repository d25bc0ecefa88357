select proj_id, count(distinct task_id) as n_tasks, count(distinct pred_task_id) as n_preds, count(*) as n_links,
  cast(sum(lag_hr_cnt) as bigint) as lag_hours
from fx_task_pred group by proj_id
