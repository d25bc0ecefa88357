select distinct budget_code, nullif(regexp_extract(budget_code, 'FC([0-9.]+)', 1), '') as fc_number from fx_budget
