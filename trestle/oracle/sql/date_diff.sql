select contract, cast(date '2001-08-01' - start_date as int) as days_open,
  cast((2001 - year(start_date)) * 12 + 8 - month(start_date) as int) as months_open,
  cast((year(owner_contract_date) - year(start_date)) * 12 + month(owner_contract_date) - month(start_date) as int) as owner_months
from fx_contract
