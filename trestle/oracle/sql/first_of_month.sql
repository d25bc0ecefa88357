select distinct month_text,
  cast(date_trunc('month', coalesce(
    cast(try_strptime(month_text, '%b-%y') as date),
    cast(try_strptime(replace(month_text, ' 00:00:00', ''), '%Y-%m-%d') as date))) as date) as month_date
from fx_sheet
