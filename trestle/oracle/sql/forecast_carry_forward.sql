with total as (
  select file_month, cast(try_cast(split_part(forecast_type, ' ', 1) as int) as int) as forecast_year,
    cast(sum(revenue) as bigint) as revenue, cast(sum(margin) as bigint) as margin
  from fx_forecast where category_type = 'Region' group by all having forecast_year is not null
), spread as (         -- the newest file also stands for every later month of the year 2001
  select unnest(if(file_month = max(file_month) over (),
    generate_series(cast(file_month as timestamp), timestamp '2001-12-01', interval 1 month), [cast(file_month as timestamp)])) as t,
    forecast_year, revenue, margin
  from total
)
select cast(t as date) as file_month_year, forecast_year, revenue, margin from spread where extract(year from t) = forecast_year
