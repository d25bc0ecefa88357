select trim(a.apco) as apco, a.mth, a.aptrans, a.apline, trim(a.jcco) as jcco, trim(a.job) as job, a.gross_cents,
  a.retainage_cents, b.paid_date, b.amount_cents
from fx_ap_line a left join fx_ap_pay b using (apco, mth, aptrans, apline)
