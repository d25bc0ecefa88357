with b as (select *, regexp_extract(budget_code, 'FC([0-9.]+)', 1) as fc_raw from fx_budget),
c as (select gl_co, gl_account, budget_code, mth, budget_cents, nullif(fc_raw, '') as fc_number from b)
select * from c where fc_number = (select max(fc_number) from c)
