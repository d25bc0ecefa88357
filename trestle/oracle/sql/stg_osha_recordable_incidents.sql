select * from fx_osha_typed
