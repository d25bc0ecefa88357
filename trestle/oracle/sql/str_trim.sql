select distinct trim(job) as job, trim(phase) as phase, trim(cast(mth as varchar)) as mth_text, trim(cost_type) as cost_type
from fx_job_cost
