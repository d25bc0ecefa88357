with u as (
  select s.*, c.table_name as source_table, c.file_month_year
  from fx_sheet s join fx_control c on s.sheet_name = c.table_name where c.active = true
)
select
  cast(date_trunc('month', coalesce(cast(try_strptime(month_text, '%b-%y') as date),
    cast(try_strptime(replace(month_text, ' 00:00:00', ''), '%Y-%m-%d') as date))) as date) as month_date,
  region, market_channel, title as project, source_table, file_month_year,
  cast(case when trim(amount_text) = '-' then null when trim(amount_text) = 'nan' then null
       when amount_text like '%(%)%' then -1 * try_cast(replace(replace(replace(amount_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(amount_text, ',', '') as decimal(38,0)) end as bigint) as pending_backlog_revenue,
  cast(case when amount_text like '%-%' then null when trim(amount_text) = 'nan' then null
       when amount_text like '%(%)%' then -1 * try_cast(replace(replace(replace(amount_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(amount_text, ',', '') as decimal(38,0)) end as bigint) as pending_backlog_margin
from u
