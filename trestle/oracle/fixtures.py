"""Test-data analogs as SQL CTEs for the DuckDB oracle (the data specification of FIXTURES.md).

The Spark side builds the same analogs with the DataFrame API in ``trestle.sources.analogs``.
"""

FIXTURE_SQL = {
    "fx_dept": """
select lpad(cast((n_regionkey + 1) * 200 + (n_nationkey % 4 + 1) * 10 as string), 4, '0') as department,
  cast(n_nationkey % 3 + 1 as string) as glco,
  'Region - ' || case n_regionkey when 0 then 'Midwest' when 1 then 'Great Lakes' when 2 then 'Mid-Atlantic' when 3 then 'Central' else 'West' end
  || ' ' || case n_nationkey % 4 when 0 then 'EDU' when 1 then 'HC' when 2 then 'IND' else 'Water' end as description
from nation
""",
    "fx_gl": """
select cast(l_partkey % 140 + 1 as string) as glco,
  case l_linenumber when 1 then '41010' when 2 then '41030' when 3 then '51000' when 4 then '61000' when 5 then '81000' when 6 then '11050' else '88200' end as part1,
  case when l_suppkey % 5 = 0 then '0000' else lpad(cast((l_suppkey % 5) * 200 + (l_suppkey % 4 + 1) * 10 as string), 4, '0') end as part2,
  case l_orderkey % 4 when 0 then '300' when 1 then '004' when 2 then '311' else '000' end as part3,
  cast(date_trunc('month', l_shipdate) as date) as mth,
  cast(floor(l_extendedprice * 100) as bigint) * case when l_linenumber <= 2 then -1 else 1 end as netamt_cents,
  case l_linenumber % 3 when 0 then 'GJ' when 1 then ' AP' else 'AR ' end as jrnl, ' ' || cast(l_orderkey % 1000 as string) as glref,
  cast(l_partkey % 7 + 1 as string) as sourceco, case when l_linenumber % 2 = 0 then 'GL Entry' else 'JC Detail' end as source,
  case when l_orderkey % 50 = 0 then 'Y' else 'N' end as adjust, case when l_orderkey % 90 = 0 then 'Y' else 'N' end as purge
from lineitem
""",
    "fx_budget": """
select cast(l_partkey % 140 + 1 as string) as gl_co,
  case l_linenumber when 1 then '41010' when 2 then '51000' else '61000' end || '.' || lpad(cast((l_suppkey % 5) * 200 + 10 as string), 4, '0') as gl_account,
  cast(year(l_shipdate) - l_orderkey % 2 as string) || case l_orderkey % 7 when 0 then ' FC9' when 1 then ' FC10' when 2 then ' FC2.6' when 3 then ' FC3.1' when 4 then ' FC1' when 5 then ' FC2' else ' BASE' end as budget_code,
  cast(date_trunc('month', l_shipdate) as date) as mth,
  cast(floor(l_extendedprice * 100) as bigint) as budget_cents
from lineitem
""",
    "fx_job_cost": """
select cast(l_linenumber % 2 + 1 as string) as jcco,
  case when l_suppkey % 2 = 0 then ' ' || cast(l_suppkey % 40 + 123000 as string) || '. ' else cast(l_suppkey % 40 + 123000 as string) || '.' end as job,
  '1' as phase_group,
  lpad(cast(case l_partkey % 20 when 0 then 96 when 1 then 80 else l_partkey % 20 end as string), 2, '0') || '1000.90' || cast(l_partkey % 9 as string) || '.' as phase,
  cast(l_linenumber % 4 + 1 as string) as cost_type,
  case l_returnflag when 'A' then 'OE' when 'R' then 'CO' else 'PF' end as trans_type,
  cast(date_trunc('month', l_shipdate) as date) as mth, cast(l_shipdate as date) as actual_date,
  cast(floor(l_extendedprice * 100) as bigint) as est_cents,
  cast(floor(l_extendedprice * 100) as bigint) + l_partkey as proj_cents,
  case when l_linestatus = 'O' then 0 else cast(floor(l_extendedprice * 50) as bigint) end as actual_cents,
  case when l_linenumber = 3 then cast(floor(l_extendedprice * 70) as bigint) else 0 end as committed_cents
from lineitem
""",
    "fx_contract": """
select cast(s_suppkey % 2 + 1 as string) as jcco, cast(s_suppkey + 123000 as string) || '.' as contract, s_name as description,
  case when s_suppkey % 3 = 0 then null else date '1996-01-01' + cast(s_suppkey % 900 as int) end as owner_contract_date,
  case when s_suppkey % 10 = 0 then date '1980-01-01' else date '1996-01-01' end + cast(s_suppkey % 700 as int) as start_date,
  cast(floor(s_acctbal * 1000) as bigint) as orig_contract_cents,
  cast(floor(s_acctbal * 1000) as bigint) + s_suppkey * 700 as contract_cents,
  case when s_suppkey % 4 = 1 then date '2001-01-01' + cast(s_suppkey % 90 as int) end as actual_close_date,
  case when s_suppkey % 8 = 3 then date '2001-03-01' end as month_closed, s_nationkey as customer,
  cast(s_suppkey % 3 as int) as contract_status, cast(floor(s_acctbal * 1000) as bigint) * 3 as received_cents
from supplier
""",
    "fx_change_item": """
select o_orderkey as key_id, cast(o_custkey % 2 + 1 as string) as jcco, cast(o_custkey % 100 + 123000 as string) || '.' as project,
  case o_orderstatus when 'F' then 'Y' when 'O' then 'N' else null end as approved,
  'A' || cast(o_orderkey % 97 as string) as aco, o_orderkey // 97 as aco_item,
  cast(o_orderdate as date) as approved_date,
  cast(floor(o_totalprice * 100) as bigint) as approved_cents, cast(floor(o_totalprice * 40) as bigint) as pending_cents, cast(floor(o_totalprice * 90) as bigint) as fixed_cents
from orders
""",
    "fx_posted_item": """
select o_orderkey * 10 + 7 as key_id, cast(o_custkey % 2 + 1 as string) as jcco, cast(o_custkey % 100 + 123000 as string) || '.' as job,
  'A' || cast(o_orderkey % 97 as string) as aco, o_orderkey // 97 as aco_item, cast(date_trunc('month', o_orderdate) as date) as approved_month
from orders where o_orderkey % 3 = 0
""",
    "fx_override": """
select jcco, trim(job) as contract, mth, sum(est_cents) - sum(est_cents) % 1000 as proj_revenue,
  case when month(mth) % 4 = 0 then sum(proj_cents) + 1000 else 0 end as proj_over_cost,
  case when month(mth) = 6 then sum(est_cents) - sum(est_cents) % 7 end as actual_cost
from fx_job_cost where trans_type = 'CO' and phase like '05%' group by jcco, trim(job), mth
""",
    "fx_week": """
select date '1999-01-01' + cast(7 * k as int) as start_week from (values (0),(1),(2),(3),(4),(5),(6),(7)) as t(k)
""",
    "fx_task": """
select o.o_orderkey % (select count(*) from customer) + b.off as proj_id, o.o_orderkey + b.off * 1000 as task_id, 'T' || cast(o.o_orderkey as string) as task_code, w.start_week,
  case o.o_orderkey % 40 when 0 then 'TT_Mile' when 1 then 'TT_FinMile' when 2 then 'TT_LOE' else 'TT_Task' end as task_type,
  case when o.o_orderkey % 40 <= 1 then 1 else 2 end as wbs_id,
  case when b.off = 0 and cast(o.o_orderdate as date) <= w.start_week then cast(o.o_orderdate as date) end as act_start_date,
  case when b.off = 0 and cast(o.o_orderdate as date) + cast(o.o_orderkey % 90 as int) <= w.start_week then cast(o.o_orderdate as date) + cast(o.o_orderkey % 90 as int) end as act_end_date,
  cast(o.o_orderdate as date) + cast(o.o_orderkey % 85 as int) as target_end_date,
  cast(o.o_orderdate as date) + cast(o.o_orderkey % 90 as int) as early_end_date,
  case o.o_orderkey % 25 when 0 then 'CS_MEO' when 1 then 'CS_MSO' when 2 then 'CS_MSOA' end as cstr_type,
  o.o_orderkey % 600 - 120 as total_float_hr_cnt, (o.o_orderkey % 30) * 8 as target_drtn_hr_cnt
from orders o cross join fx_week w cross join (values (cast(0 as bigint)), (1000000000)) as b(off)
""",
    "fx_task_tag": """
select proj_id, task_id, start_week, 'OFG' as short_name from fx_task where task_id % 11 = 0
""",
    "fx_task_pred": """
select l_orderkey % (select count(*) from customer) as proj_id, l_orderkey as task_id, l_orderkey - (select count(*) from customer) * l_linenumber as pred_task_id, l_orderkey * 10 + l_linenumber as task_pred_id,
  case l_linenumber % 4 when 0 then 'PR_SS' when 1 then 'PR_FS' when 2 then 'PR_FF' else 'PR_SF' end as pred_type,
  cast(l_quantity as int) % 7 - 2 as lag_hr_cnt
from lineitem where l_orderkey % 3 <> 0 and l_orderkey >= (select count(*) from customer) * l_linenumber
""",
    "fx_project": """
select c_custkey % (select count(*) from customer) as proj_id, c_custkey % (select count(*) from customer) + 1000000000 as baseline_proj_id, 'P' || cast(c_custkey as string) as proj_name, cast(c_custkey % 40 + 123000 as string) as project_name,
  date '1999-01-20' as last_recalc_date, case when c_custkey % 2 = 0 then 8 else 10 end as day_hr_cnt, 40 as week_hr_cnt, date '1999-06-30' + cast(c_custkey % 60 as int) as completion_date
from customer
""",
    "fx_baseline": """
select c_custkey % n as orig_proj_id, c_custkey % n + 1000000000 as baseline_proj_id,
  case when c_custkey % 7 <> 0 then date '1999-01-20' - cast(c_custkey % 5 as int) end as last_baseline_update_date
from customer, (select count(*) as n from customer) as c
union all
select c_custkey % n, (c_custkey + 1) % n + 1000000000, date '1999-01-20' + case when c_custkey % 2 = 0 then 5 else -9 end
from customer, (select count(*) as n from customer) as c where c_custkey % 3 = 0
""",
    "fx_weekly": """
select proj_id, start_week as week_ending, min(total_float_hr_cnt) as total_float, sum(case when act_end_date is not null then target_drtn_hr_cnt else 0 end) as resources_to_date,
  sum(case when act_end_date is null then target_drtn_hr_cnt else 0 end) as next_week_resources
from fx_task where proj_id < 1000000000 and not (proj_id % 9 = 0 and start_week = date '1999-01-22') group by proj_id, start_week
""",
    "fx_opportunity": """
select event_id as version_id, user_id as opportunity_id, case when event_id % 13 = 0 then null else ts end as load_ts,
  case event_type when 'purchase' then 'Closed Won' when 'error' then 'Closed Lost' when 'view' then 'Open' when 'click' then 'Pending' else 'Lead' end as stage_type,
  case event_id % 9 when 0 then 'yes' when 1 then 'No' when 2 then '0' else 'false' end as delete_record, cast(value as string) as size_text, event_type as market_name,
  'Client ' || cast(user_id % 97 as string) as client_name, '<p class="n">Call&nbsp;' || cast(event_id % 9 + 1 as string) || '</p><br/>' as next_action_html
from events
""",
    "fx_incident": """
select case when event_id % 50 = 0 then 'Link' else 'http://x/' || cast(event_id as string) end as link,
  lpad(cast(month(ts) as string), 2, '0') || '/' || lpad(cast(day(ts) as string), 2, '0') || '/' || cast(year(ts) as string) as injury_date_text,
  lpad(cast(event_id % 12 + 1 as string), 2, '0') || ':15 ' || case when event_id % 2 = 0 then 'AM' else 'PM' end as injury_time_text,
  case when event_id % 3 = 0 then 'Near Miss' else 'Injury' end as incident_type, 'Region ' || cast(user_id % 5 as string) as region,
  cast(case when event_id % 6 <> 0 then event_id % 30 end as int) as days_lost,
  case event_id % 4 when 0 then 'true' else 'false' end as days_away, case event_id % 5 when 0 then 'true' else 'false' end as transfer, case event_id % 97 when 0 then 'true' else 'false' end as death
from events where event_type = 'error'
""",
    "fx_sheet": """
select 'sheet_' || lower(o_orderstatus) as sheet_name,
  case when o_orderkey % 2 = 0 then substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate) * 3 - 2, 3) || '-' || substr(cast(year(o_orderdate) as string), 3, 2)
       else substr(cast(cast(o_orderdate as date) as string), 1, 10) || ' 00:00:00' end as month_text,
  o_orderpriority as region, cast(o_orderkey as string) as title,
  case o_orderkey % 6 when 0 then ' - ' when 1 then 'nan' when 2 then '(' || cast(o_orderkey % 9 + 1 as string) || ',' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || ')' when 3 then '-5' when 4 then null
       else cast(o_orderkey % 9 + 1 as string) || ',' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '.50' end as amount_text,
  case (o_orderkey + 2) % 6 when 0 then ' - ' when 1 then 'nan' when 2 then '(' || cast(o_orderkey % 9 + 1 as string) || ',' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || ')' when 3 then '-5' when 4 then null
       else cast(o_orderkey % 9 + 1 as string) || ',' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '.50' end as actual_text,
  case o_custkey % 4 when 0 then 'EDU' when 1 then 'HC' when 2 then 'IND' else 'Water' end as market_channel
from orders
""",
    "fx_control": """
select * from (values ('sheet_f', '2001-05-01', true, 1), ('sheet_o', '2001-06-01', true, 2), ('sheet_o', '2001-05-01', true, 1), ('sheet_p', '2001-07-01', false, 1)) as t(table_name, file_month_year, active, load_no)
""",
    "fx_forecast": """
select cast(year(o_orderdate) as string) || ' Rolling Forecast' as forecast_type, case when o_orderkey % 3 = 0 then 'Region' else 'Market' end as category_type,
  o_orderpriority as category, cast(floor(o_totalprice) as bigint) as revenue, cast(floor(o_totalprice / 10) as bigint) as margin, cast(date_trunc('month', o_orderdate) as date) as file_month
from orders
""",
}


# Analogs that depend on other analogs (must be defined first in the WITH list).
FIXTURE_DEPS = {
    "fx_override": ["fx_job_cost"],
    "fx_task": ["fx_week"],
    "fx_task_tag": ["fx_task"],
    "fx_weekly": ["fx_task"],
}


def resolve(names):
    """Fixture names in dependency order, each once."""
    order = []

    def visit(n):
        for d in FIXTURE_DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order
