select jcco, trim(job) as job,
  cast(sum(case when trans_type = 'OE' then est_cents end) as bigint) as oe_cents,
  cast(sum(case when trans_type = 'CO' and phase like '05%' then est_cents end) as bigint) as co_cents,
  cast(sum(case when trans_type = 'PF' then est_cents end) as bigint) as pf_cents
from fx_job_cost group by jcco, trim(job)
