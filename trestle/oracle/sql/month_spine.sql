select jcco, contract, start_date, cast(unnest(range(len(months))) as int) as month_offset, cast(unnest(months) as date) as month
from (select jcco, contract, start_date,
        generate_series(date_trunc('month', cast(start_date as timestamp)), timestamp '2001-08-01', interval 1 month) as months
      from fx_contract)
