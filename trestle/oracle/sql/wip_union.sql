select s.job_number, s.job_description, s.region, s.revenue_backlog, s.ytd_revenue, s.include_job, c.table_name as source_table, c.file_month_year
from fx_wip_sheet s join fx_control c on s.sheet_name = c.table_name where c.active = true
