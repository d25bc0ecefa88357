select trim(jcco) as jcco, trim(job) as job, mth, actual_date, trans_type, phase_group, trim(phase) as phase, cost_type,
  case when trans_type in ('OE', 'CO') then est_cents when trans_type = 'PF' then proj_cents else 0 end as estimated_cents
from fx_job_cost where trim(trans_type) in ('OE', 'CO', 'PF')
