select * from fx_practice_area_typed
