select * from fx_opportunity order by load_ts desc nulls first, version_id desc nulls first limit 1
