with b as (select budget_code, nullif(regexp_extract(budget_code, 'FC([0-9.]+)', 1), '') as fc_number from fx_budget)
select distinct budget_code, fc_number, cast(floor(try_cast(fc_number as double)) as bigint) as fc_floor from b
