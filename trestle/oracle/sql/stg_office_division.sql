select office_division_id, office_division_description, opportunity_id, last_load_dt from fx_office_division
