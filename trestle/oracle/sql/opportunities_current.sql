with newest as (       -- an empty load time counts as the newest
  from q_opportunities_typed
  select opportunity_number, arg_max(version_id, (coalesce(last_modified_date_time, timestamp '9999-01-01'), version_id)) as version_id
  where not delete_record group by all
), size as (
  select opportunity_id, arg_max({v: estimated_project_size}, (coalesce(last_load_dt, timestamp '9999-01-01'), version_id)).v as project_size
  from q_stg_opportunity_size group by all
), unit as (
  select opportunity_id, arg_max(unit_of_measure, (last_load_dt, unit_of_measure)) as unit_of_measure from fx_opp_uom group by all
), market as (         -- names, and the CRM ids that the region and market dimension knows, of the newest load
  select opportunity_id, array_to_string(list_sort(list_distinct(list(practice_area_name))), ', ') as market_channel,
    coalesce(array_to_string(list_sort(list_distinct(list(practice_area_id) filter (
      practice_area_id in (select unanet_market_id from q_dim_region_market)))), ', '), '') as market_number
  from (select *, max(last_load_dt) over (partition by opportunity_id) as newest from fx_opp_practice_area)
  where last_load_dt = newest group by all
), method as (
  select opportunity_id, array_to_string(list_sort(list_distinct(list(delivery_method_name))), ', ') as delivery_method
  from (select *, max(last_load_dt) over (partition by opportunity_id) as newest from fx_opp_delivery_method)
  where last_load_dt = newest group by all
), office as (
  select opportunity_id, arg_max({r: region_number, d: office_division_description},
    (last_load_dt, coalesce(region_number, 'zz'), office_division_id)) as x
  from fx_office_division left join (
    select distinct unanet_region_id as office_division_id, region_number from q_dim_region_market where region_number not like '%9.%'
  ) using (office_division_id) group by all
), debrief as (
  select opportunity_id, arg_max({c: debrief_call_complete}, (last_load_dt, coalesce(cast(debrief_call_complete as int), 2))).c as debrief_call_complete
  from q_stg_opportunity_debrief_call_complete group by all
)
select o.opportunity_id, client_id, client_name, opportunity_name, cost, coalesce(project_size, o.size) as size, unit_of_measure, probability,
  stage, stage_type, market_number, market_channel, x.r as region_number, x.d as region, delivery_method, debrief_call_complete,
  replace(regexp_replace(next_action, '<[^>]+>', '', 'g'), '&nbsp;', '') as next_action,
  replace(regexp_replace(note, '<[^>]+>', '', 'g'), '&nbsp;', '') as note,
  o.opportunity_number, address1, city, state, postal_code, country, construction_start_date, construction_completion_date,
  create_date_time, last_modified_date_time
from newest join q_opportunities_typed o using (version_id)
  left join size using (opportunity_id) left join unit using (opportunity_id) left join market using (opportunity_id)
  left join method using (opportunity_id) left join office using (opportunity_id) left join debrief using (opportunity_id)
