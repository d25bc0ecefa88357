select datetime as submit_datetime, injury_date, job_title, field_office, injury_type, periods_away_restricted,
  select_days_away_from_work = 'true' as select_days_away_from_work,
  select_job_transfer_or_restriction = 'true' as select_job_transfer_or_restriction,
  select_death = 'true' as select_death, select_other_recordable_case = 'true' as select_other_recordable_case, outcome_2 as injury_outcome,
  coalesce(if(select_days_away_from_work = 'true', 'Days Away', null), if(select_job_transfer_or_restriction = 'true', 'Job Transfer', null),
    if(select_death = 'true', 'Death', null), 'Other Recordable') || ' Incident' as incident_type
from q_stg_osha_recordable_incidents
