select * from fx_opp_delivery_method
