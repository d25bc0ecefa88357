select job, month_date,
  cast(sum(negative_ctc_indicator) as bigint) as negative_ctc_count, cast(sum(po_variance_opp_indicator) as bigint) as po_variance_opp_count,
  cast(sum(profit_at_risk_indicator) as bigint) as profit_at_risk_count, cast(sum(negative_ctc_value) as bigint) as negative_ctc_value,
  cast(sum(po_variance_opp_value) as bigint) as po_variance_opp_value, cast(sum(profit_at_risk_value) as bigint) as profit_at_risk_value
from q_job_cost_monthly group by job, month_date
