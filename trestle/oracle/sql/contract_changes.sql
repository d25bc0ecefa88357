with u as (
  select jcco, contract, start_month as change_date, orig_contract_cents as contract_amt from q_contract_master
  union all
  select pmco, project, approved_date, approved_cents from q_change_orders where is_pending = false
)
select jcco, contract, change_date, cast(date_trunc('month', change_date) as date) as change_month, cast(contract_amt as double) as contract_amt
from u
