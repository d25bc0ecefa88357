with f as (select glco, part2, mth, sum(netamt_cents) as company_cents from fx_gl group by all)
select part2, mth, cast(sum(company_cents) as bigint) as total_cents, count(*) as n_companies,
  cast(max(company_cents) as bigint) as max_company_cents
from f group by part2, mth
