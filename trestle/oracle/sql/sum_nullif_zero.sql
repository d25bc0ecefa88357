select jcco, contract, cast(nullif(sum(proj_over_cost), 0) as bigint) as proj_over_cost,
  cast(nullif(sum(proj_revenue), 0) as bigint) as proj_revenue
from fx_override group by jcco, contract
