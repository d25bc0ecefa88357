select * from fx_job_cost
