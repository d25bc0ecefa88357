select * from fx_opportunity
qualify row_number() over (partition by opportunity_id order by load_ts desc nulls first, version_id desc nulls first) = 1
