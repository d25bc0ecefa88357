with one as (
  select * from fx_control where active = true order by table_name, file_month_year limit 1
)
select s.month_text, s.region, s.title, s.amount_text, s.actual_text, s.market_channel, c.table_name as source_table, c.file_month_year
from fx_sheet s join one c on s.sheet_name = c.table_name
