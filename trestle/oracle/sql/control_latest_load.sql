with latest as (
  select * from fx_control qualify load_no = max(load_no) over (partition by table_name)
)
select s.month_text, s.region, s.title, s.amount_text, s.actual_text, s.market_channel, c.table_name as source_table, c.file_month_year
from fx_sheet s join latest c on s.sheet_name = c.table_name
