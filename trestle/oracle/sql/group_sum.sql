select jcco, trim(job) as job, phase, cost_type, cast(sum(est_cents) as bigint) as est_cents,
  cast(sum(proj_cents) as bigint) as proj_cents, cast(sum(actual_cents) as bigint) as actual_cents,
  max(mth) as last_mth, min(mth) as first_mth
from fx_job_cost group by jcco, trim(job), phase, cost_type
