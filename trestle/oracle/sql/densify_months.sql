with spine as (
  select jcco, contract, cast(unnest(generate_series(date_trunc('month', cast(start_date as timestamp)), timestamp '2001-08-01',
    interval 1 month)) as date) as month
  from fx_contract
), m as (
  select jcco, trim(job) as contract, mth as month, sum(actual_cents) as cents from fx_job_cost group by all
)
select jcco, contract, month, cast(coalesce(cents, 0) as bigint) as actual_cents from spine left join m using (jcco, contract, month)
