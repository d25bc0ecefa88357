select opportunity_id, cast(try_cast(size_text as decimal(38,0)) as bigint) as estimated_project_size, load_ts as last_load_dt, version_id
from fx_opportunity
