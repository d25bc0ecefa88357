select j.jcco, j.job, j.phase, j.actual_date, j.est_cents, k.contract, k.description
from fx_job_cost j left join fx_contract k on trim(j.jcco) = trim(k.jcco) and trim(j.job) = trim(k.contract)
