with u as (
  select s.*, c.table_name as source_table
  from fx_sheet s join (select distinct table_name from fx_control) c on s.sheet_name = c.table_name
)
select
  cast(date_trunc('month', coalesce(cast(try_strptime(month_text, '%b-%y') as date),
    cast(try_strptime(replace(month_text, ' 00:00:00', ''), '%Y-%m-%d') as date))) as date) as month_date,
  source_table, region, market_channel, title as project,
  cast(case when trim(amount_text) = '-' then null when trim(amount_text) = 'nan' then null
       when amount_text like '%(%)%' then -1 * try_cast(replace(replace(replace(amount_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(amount_text, ',', '') as decimal(38,0)) end as bigint) as plan_sales,
  cast(case when trim(actual_text) = '-' then null when trim(actual_text) = 'nan' then null
       when actual_text like '%(%)%' then -1 * try_cast(replace(replace(replace(actual_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(actual_text, ',', '') as decimal(38,0)) end as bigint) as actual_sales
from u
