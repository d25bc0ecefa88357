select contract, cast(year(start_date) as int) as yr, cast(month(start_date) as int) as mo, last_day(start_date) as month_end from fx_contract
