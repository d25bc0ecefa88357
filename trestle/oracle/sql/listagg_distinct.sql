select opportunity_id,
  coalesce(array_to_string(list_sort(list_distinct(list(market_name))), ', '), '') as markets,
  coalesce(array_to_string(list_transform(list_sort(list_distinct(list(version_id % 5))), lambda x: cast(x as varchar)), ', '), '') as version_buckets,
  coalesce(array_to_string(list_sort(list_distinct(list(case when stage_type = 'Lead' then stage_type end))), ', '), '') as lead_stages
from fx_opportunity group by opportunity_id
