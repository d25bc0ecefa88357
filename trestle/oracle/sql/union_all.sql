select jcco, contract, cast(date_trunc('month', start_date) as date) as month, orig_contract_cents as amount_cents, 'original' as kind
from fx_contract
union all
select jcco, project, cast(date_trunc('month', approved_date) as date), approved_cents, 'change'
from fx_change_item where approved = 'Y'
