select * from fx_opportunity_typed
