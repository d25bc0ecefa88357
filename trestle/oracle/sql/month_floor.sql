select distinct actual_date, cast(date_trunc('month', actual_date) as date) as month from fx_job_cost
