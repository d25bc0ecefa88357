select jcco, trim(job) as job from fx_job_cost where actual_cents != 0
union
select jcco, trim(job) from fx_job_cost where committed_cents != 0
union
select jcco, trim(job) from fx_job_cost where trans_type in ('OE', 'CO')
