with r as (select *, 'rf_' || strftime(file_month, '%Y%m') as file_name from fx_forecast),
c as (select distinct file_name as table_name, cast(file_month as varchar) as file_month_year from r)
select r.forecast_type, r.category_type, r.category, r.revenue, r.margin, round(r.margin / r.revenue, 6) as pct_margin,
  c.table_name as source_table, c.file_month_year
from r join c on r.file_name = c.table_name
