select region, project, incident_type, datetime_of_incident, observer, employee_involved, description_1
from q_stg_incident_notification
order by datetime_of_incident desc nulls first, link asc nulls last
