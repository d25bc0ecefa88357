with jd as (
  select jcco, job, contract, description, start_date, actual_close_date from q_contract_master
), pj as (
  select jcco, job,
    cast(sum(case when trans_type = 'OE' then est_cents end) as bigint) as orig_estimate, max(case when trans_type = 'OE' then actual_date end) as orig_est_max_date,
    cast(sum(case when trans_type in ('OE', 'CO') then est_cents end) as bigint) as curr_estimate,
    max(case when trans_type in ('OE', 'CO') then actual_date end) as curr_est_max_date,
    cast(sum(case when trans_type = 'PF' then proj_cents end) as bigint) as proj_estimate, max(case when trans_type = 'PF' then actual_date end) as proj_est_max_date,
    cast(sum(actual_cents) as bigint) as cost_to_date, cast(sum(committed_cents) as bigint) as committed_cost, max(actual_date) as cost_max_date
  from fx_job_cost group by jcco, job
), x as (
  select jd.*, pj.* exclude (jcco, job),
    round(case when proj_estimate = 0 then null else cost_to_date / proj_estimate end * 100, 2) as percent_complete,
    case when orig_estimate = 0 then 'zero est' when proj_estimate > orig_estimate then 'over' when proj_estimate = orig_estimate then 'same'
         when proj_estimate < orig_estimate then 'under' end as comp_orig_est,
    case when curr_estimate = 0 then 'zero est' when proj_estimate > curr_estimate then 'over' when proj_estimate = curr_estimate then 'same'
         when proj_estimate < curr_estimate then 'under' end as comp_curr_est
  from jd left join pj on jd.jcco = pj.jcco and jd.job = pj.job
)
select * from x where start_date >= date '1996-01-01' and (percent_complete >= 98 or actual_close_date is not null)
  and cost_to_date > 0 and percent_complete <= 100
