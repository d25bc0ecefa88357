with m as (
  select jcco, trim(job) as job, cost_type, phase_group, phase, mth,
    cast(sum(actual_cents) as bigint) as actual_cents, cast(sum(est_cents) as bigint) as est_cents
  from fx_job_cost group by all
)
select *,
  cast(sum(actual_cents) over (partition by job, cost_type, phase_group, phase order by mth) as bigint) as actual_cents_running,
  cast(sum(est_cents) over (partition by job, cost_type, phase_group, phase order by mth) as bigint) as est_cents_running
from m
