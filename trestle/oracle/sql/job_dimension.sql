with cm as (
  select trim(jcco) as jcco, trim(contract) as contract, trim(contract) as job, description,
    coalesce(owner_contract_date, start_date) as start_date, orig_contract_cents, contract_cents, received_cents, coalesce(actual_close_date, month_closed) as close_date, customer, contract_status
  from fx_contract
), est as (
  select trim(jcco) as jcco, trim(job) as job,
    sum(case when trans_type = 'OE' then est_cents end) as orig_estimate,
    sum(case when trans_type in ('OE', 'CO') then est_cents end) as curr_estimate,
    sum(case when trans_type = 'PF' then proj_cents end) as proj_estimate
  from fx_job_cost where trim(trans_type) in ('OE', 'CO', 'PF') group by 1, 2
), ctd as (
  select trim(jcco) as jcco, trim(job) as job, sum(actual_cents) as cost_to_date from fx_job_cost where actual_cents != 0 group by 1, 2
), co as (
  select pmco as jcco, project as job,
    sum(if(is_pending, 0, approved_cents)) as approved_change_orders, sum(if(is_pending, pending_cents, 0)) as pending_change_orders
  from q_change_orders group by all
), ar as (
  select trim(jcco) as jcco, trim(contract) as job, sum(invoiced_cents) - sum(paid_cents) - sum(retainage_cents) as ar_balance,
    sum(invoiced_cents) as billed_amt, sum(retainage_cents) as current_retain_amt
  from fx_ar group by 1, 2
), ap as (
  select trim(a.jcco) as jcco, trim(a.job) as job, sum(b.amount_cents) as ap_balance
  from fx_ap_line a left join fx_ap_pay b using (apco, mth, aptrans, apline) where b.paid_date is null group by 1, 2
), h as (
  select distinct cm.jcco, cm.contract, cm.job, cm.description, cm.job || ' - ' || cm.description as job_number_name,
    cm.start_date, cm.close_date, cm.customer, cm.contract_status, cm.orig_contract_cents as orig_contract_amt, cm.contract_cents as contract_amt, cm.received_cents as received_amt, cast(ar.billed_amt as bigint) as billed_amt,
    cast(ar.current_retain_amt as bigint) as current_retain_amt,
    cast(co.approved_change_orders as bigint) as approved_change_orders, cast(co.pending_change_orders as bigint) as pending_change_orders,
    cast(cm.orig_contract_cents - est.orig_estimate as bigint) as orig_gross_margin,
    cast(cm.contract_cents - est.curr_estimate as bigint) as curr_gross_margin,
    cast(cm.contract_cents - est.proj_estimate as bigint) as proj_gross_margin,
    round(case when cm.orig_contract_cents = 0 then 0 else (cm.orig_contract_cents - est.orig_estimate) / cm.orig_contract_cents end, 6) as orig_gross_margin_pct,
    round(case when cm.contract_cents = 0 then 0 else (cm.contract_cents - est.curr_estimate) / cm.contract_cents end, 6) as curr_gross_margin_pct,
    round(case when cm.contract_cents = 0 then 0 else (cm.contract_cents - est.proj_estimate) / cm.contract_cents end, 6) as proj_gross_margin_pct,
    round((case when ctd.cost_to_date is null or est.curr_estimate is null then null when est.curr_estimate = 0 then 0
           else ctd.cost_to_date / est.curr_estimate end) * cm.contract_cents, 2) as earned_revenue,
    round(ar.billed_amt - (case when ctd.cost_to_date is null or est.proj_estimate is null then null when est.proj_estimate = 0 then 0
           else ctd.cost_to_date / est.proj_estimate end) * cm.contract_cents, 2) as over_under_billed,
    cast(ar.ar_balance as bigint) as ar_balance, cast(ap.ap_balance as bigint) as ap_balance,
    cast((ar.billed_amt - ar.ar_balance - ar.current_retain_amt) - (ctd.cost_to_date - ap.ap_balance) as bigint) as cash_flow,
    cast(est.orig_estimate as bigint) as orig_estimate, cast(est.curr_estimate as bigint) as curr_estimate,
    cast(est.proj_estimate as bigint) as proj_estimate, cast(ctd.cost_to_date as bigint) as cost_to_date,
    cast(est.proj_estimate - ctd.cost_to_date as bigint) as cost_to_complete,
    cast(est.curr_estimate - est.proj_estimate as bigint) as over_under,
    round(case when ctd.cost_to_date is null or est.proj_estimate is null then null when est.proj_estimate = 0 then 0
           else ctd.cost_to_date / est.proj_estimate end, 6) as percent_complete
  from cm left join co using (jcco, job) left join est using (jcco, job) left join ctd using (jcco, job)
    left join ap using (jcco, job) left join ar using (jcco, job)
)
select * from h where start_date >= date '1991-08-01'
