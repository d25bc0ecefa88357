select * from fx_opp_uom
