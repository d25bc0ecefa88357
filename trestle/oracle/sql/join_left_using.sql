with c as (
  select jcco, trim(job) as contract, cast(sum(est_cents) as bigint) as est_cents, cast(sum(actual_cents) as bigint) as actual_cents
  from fx_job_cost group by jcco, trim(job)
)
select c.jcco, c.contract, c.est_cents, c.actual_cents, k.description, k.orig_contract_cents
from c left join fx_contract k on c.jcco = k.jcco and c.contract = k.contract
