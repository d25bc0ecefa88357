select job_number, job_description, region, file_month_year, revenue_backlog, ytd_revenue from q_wip_union where include_job = 'True'
