select trim(jcco) as jcco, trim(job) as job, mth, actual_date, trans_type, trim(phase_group) as phase_group,
  trim(phase) as phase, cost_type, actual_cents
from fx_job_cost where actual_cents != 0
