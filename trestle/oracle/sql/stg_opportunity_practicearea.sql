select * from fx_opp_practice_area
