with wk as (
  select w.proj_id, w.week_ending, p.project_name as job_key from fx_weekly w join fx_project p on w.proj_id = p.proj_id
), jc as (
  select split_part(trim(job), '.', 1) as job_key, actual_date, actual_cents from fx_job_cost
)
select wk.proj_id, wk.week_ending, wk.job_key,
  cast(coalesce(sum(case when jc.actual_date between wk.week_ending - 41 and wk.week_ending then jc.actual_cents else 0 end), 0) as bigint) as cost_6w
from wk left join jc on wk.job_key = jc.job_key
group by wk.proj_id, wk.week_ending, wk.job_key
