select event_id, timezone('America/Chicago', timezone('UTC', ts)) as ts_central from events
