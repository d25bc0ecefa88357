select proj_id, start_week,
  cast(sum(case when act_end_date is null then 1 else 0 end) as bigint) as open_tasks,
  cast(sum(case when task_type in ('TT_Mile', 'TT_FinMile') then 1 else 0 end) as bigint) as milestones,
  cast(sum(case when cstr_type in ('CS_MEO', 'CS_MSO') then 1 else 0 end) as bigint) as hard_constraints,
  cast(sum(case when act_end_date is null then total_float_hr_cnt else 0 end) as bigint) as open_float_hours
from fx_task group by proj_id, start_week
