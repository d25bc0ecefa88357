select trim(arco) as arco, mth, artrans, trim(jcco) as jcco, trim(contract) as contract, invoiced_cents, paid_cents,
  retainage_cents
from fx_ar
