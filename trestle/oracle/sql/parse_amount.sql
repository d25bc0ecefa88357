select title, amount_text,
  cast(case when trim(amount_text) = '-' then null
       when trim(amount_text) = 'nan' then null
       when amount_text like '%(%)%' then -1 * try_cast(replace(replace(replace(amount_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(amount_text, ',', '') as decimal(38,0)) end as bigint) as amount,
  cast(case when amount_text like '%-%' then null
       when trim(amount_text) = 'nan' then null
       when amount_text like '%(%)%' then -1 * try_cast(replace(replace(replace(amount_text, ',', ''), '(', ''), ')', '') as decimal(38,0))
       else try_cast(replace(amount_text, ',', '') as decimal(38,0)) end as bigint) as amount_margin_rule
from fx_sheet
