select contract, start_date, start_date + 30 as plus_30d, start_date - 42 as minus_6w,
  cast(start_date + interval 1 month as date) as plus_1m, cast(start_date - interval 8 year as date) as minus_8y
from fx_contract
