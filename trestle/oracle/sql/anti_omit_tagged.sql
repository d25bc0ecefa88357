select t.*, cast(null as varchar) as short_name
from fx_task t
where not exists (select 1 from fx_task_tag g where g.short_name = 'OFG' and g.proj_id = t.proj_id
                  and g.task_id = t.task_id and g.start_week = t.start_week)
