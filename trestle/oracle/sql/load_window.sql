select min(ts) as first_load_dt, max(ts) as last_load_dt from events where event_type != 'error'
