select version_id, delete_record,
  case when lower(trim(delete_record)) in ('true','t','yes','y','on','1') then true
       when lower(trim(delete_record)) in ('false','f','no','n','off','0') then false end as is_deleted
from fx_opportunity
