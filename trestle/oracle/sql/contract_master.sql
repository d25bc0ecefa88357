select trim(jcco) as jcco, trim(contract) as contract, trim(contract) as job, description,
  cast(date_trunc('month', start_date) as date) as start_month,
  coalesce(owner_contract_date, start_date, cast(date_trunc('month', start_date) as date)) as start_date,
  orig_contract_cents, contract_cents, received_cents, actual_close_date, month_closed, customer, contract_status
from fx_contract
