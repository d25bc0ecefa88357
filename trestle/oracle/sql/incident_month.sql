select submit_datetime, injury_date, cast(date_trunc('month', injury_date) as date) as injury_month, job_title, field_office, incident_type,
  coalesce(cast(periods_away_restricted as int), 0) as periods_away_or_restricted
from q_incident_type
