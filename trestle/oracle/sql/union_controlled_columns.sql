select s.month_text, s.region, s.title, s.amount_text, c.table_name as source_table
from fx_sheet s join (select distinct table_name from fx_control) c on s.sheet_name = c.table_name
