select trim(jcco) as jcco, trim(job) as job, mth, actual_date, trans_type, phase_group, trim(phase) as phase, cost_type,
  committed_cents
from fx_job_cost where committed_cents != 0
