with posted as (
  select key_id as jcoi_key_id, jcco, job as project, aco, aco_item, approved_month from fx_posted_item
)
select jcco as pmco, trim(project) as project, trim(project) as contract, approved, approved_date, approved_cents, fixed_cents,
  approved_month, key_id as pmoi_key_id, jcoi_key_id,
  coalesce(approved <> 'Y' or jcoi_key_id is null and approved = 'Y', false) as is_pending,
  if(approved <> 'Y', pending_cents, if(approved = 'Y' and jcoi_key_id is null, approved_cents, fixed_cents)) as pending_cents
from (
  select distinct on (key_id, jcoi_key_id) * from fx_change_item left join posted using (jcco, project, aco, aco_item)
  order by key_id, jcoi_key_id, approved_date)
