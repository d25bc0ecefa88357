select jcco, contract, jcco || '-' || contract as company_contract,
  contract || ' ' || cast(owner_contract_date as varchar) as owner_label
from fx_contract
