select s.month_text, s.region, s.title, s.amount_text, s.actual_text, s.market_channel, c.table_name as source_table, c.file_month_year
from fx_sheet s join fx_control c on s.sheet_name = c.table_name
where c.active = true
