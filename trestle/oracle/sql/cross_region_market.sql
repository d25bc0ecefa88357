select distinct d.office_division_id, d.office_division_description, a.practice_area_id,
  case when a.practice_area_name = 'Water Resources' then 'Water' else a.practice_area_name end as practice_area_name
from fx_office_division d cross join fx_practice_area a
