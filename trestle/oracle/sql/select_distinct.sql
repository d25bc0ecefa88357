select distinct trim(jcco) as jcco, trim(job) as job, cost_type, trim(phase_group) as phase_group, trim(phase) as phase
from fx_job_cost
