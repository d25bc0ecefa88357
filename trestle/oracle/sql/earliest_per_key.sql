select * from fx_opportunity
qualify row_number() over (partition by opportunity_id order by load_ts asc nulls last, version_id asc nulls last) = 1
