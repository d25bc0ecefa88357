select file_month_year as mth, 'Rolling Forecast' as rev_type, revenue, cast(null as double) as direct_cost,
  cast(null as double) as indirect_cost, margin
from q_forecast_carry_forward
