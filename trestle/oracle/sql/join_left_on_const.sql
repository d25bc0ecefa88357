select k.jcco, k.contract, i.key_id, i.approved_cents
from fx_contract k left join fx_change_item i on k.jcco = i.jcco and k.contract = i.project and i.approved = 'Y'
