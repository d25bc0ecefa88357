select i.jcco, i.project as contract, i.key_id, i.approved_cents, k.description
from fx_change_item i join fx_contract k on i.jcco = k.jcco and i.project = k.contract
