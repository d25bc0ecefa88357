select distinct cast(year(mth) as varchar) as year_text, cast(year(mth) as varchar) || ' Plan' as plan_name from fx_budget
