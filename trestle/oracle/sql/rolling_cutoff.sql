select jcco, mth, cast(sum(est_cents) as bigint) as est_cents
from fx_job_cost where mth >= cast(date_trunc('month', date '2001-08-01' - interval 8 year) as date)
group by jcco, mth
