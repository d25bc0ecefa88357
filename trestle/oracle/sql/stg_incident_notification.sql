select * from fx_incident_typed
