select jcco, contract, coalesce(owner_contract_date, start_date) as start_date,
  ifnull(cast(owner_contract_date as varchar), 'none') as owner_text, nullif(orig_contract_cents % 7, 0) as mod7_or_null
from fx_contract
