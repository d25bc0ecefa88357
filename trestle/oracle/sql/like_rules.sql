select title, region, region like '1-%' as is_prefix, region like '%LOW' as is_suffix, region like '%NOT%' as is_contains,
  lower(region) like '%urgent%' as is_contains_ci, region = '3-MEDIUM' as is_equal,
  (region like '2-%' or region like '%SPECIFIED') as is_any
from fx_sheet
