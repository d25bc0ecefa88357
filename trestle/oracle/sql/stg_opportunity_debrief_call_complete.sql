select opportunity_id,
  case when lower(trim(debrief_text)) in ('true','t','yes','y','on','1') then true
       when lower(trim(debrief_text)) in ('false','f','no','n','off','0') then false end as debrief_call_complete,
  last_load_dt
from fx_opp_debrief
