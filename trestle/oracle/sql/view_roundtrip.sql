select * from fx_contract
