select month_date as mth, region as region_name, market_channel as market_name, project, cast(pending_backlog_revenue as double) as pending_backlog_revenue,
  cast(pending_backlog_margin as double) as pending_backlog_margin
from q_pending_backlog_clean
