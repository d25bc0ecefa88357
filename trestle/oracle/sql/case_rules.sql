select proj_id, task_id, start_week,
  case when act_end_date is not null then 'done'
       when act_start_date is not null then 'started'
       else case when cstr_type = 'CS_MEO' then 'hard-end' when cstr_type = 'CS_MSO' then 'hard-start' else 'soft' end
  end as kind
from fx_task
