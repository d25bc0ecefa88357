select link, try_strptime(injury_date_text, '%m/%d/%Y') as injury_ts,
  try_strptime(injury_date_text || ' 01:30 PM', '%m/%d/%Y %I:%M %p') as injury_ts_pm
from fx_incident
