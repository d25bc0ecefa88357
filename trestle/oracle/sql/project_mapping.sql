select version_id as opportunity_version_id, opportunity_id, load_ts as last_load_dt, stage_type,
  case when lower(trim(delete_record)) in ('true','t','yes','y','on','1') then true
       when lower(trim(delete_record)) in ('false','f','no','n','off','0') then false end as delete_record,
  cast(try_cast(size_text as decimal(38,0)) as bigint) as size, market_name
from fx_opportunity
