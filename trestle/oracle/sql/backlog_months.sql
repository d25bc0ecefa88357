with ba as (
  select cast(file_month_year as date) as mth, cast(sum(revenue_backlog) * 1000 as bigint) as revenue_backlog,
    cast(sum(ytd_revenue) as bigint) as ytd_revenue
  from q_project_backlog group by file_month_year
), pb as (
  select mth, sum(pending_backlog_revenue) as revenue_pending_backlog from q_pending_backlog_prof group by mth
)
select ba.mth, cast(month(ba.mth) as int) as mth_of_year, ba.revenue_backlog, pb.revenue_pending_backlog, ba.ytd_revenue,
  round(case when ba.ytd_revenue / month(ba.mth) = 0 then null else ba.revenue_backlog / (ba.ytd_revenue / month(ba.mth)) end, 6) as executed_backlog_months,
  round(case when ba.ytd_revenue / month(ba.mth) = 0 then null else pb.revenue_pending_backlog / (ba.ytd_revenue / month(ba.mth)) end, 6) as pending_backlog_months
from ba left join pb on ba.mth = pb.mth
