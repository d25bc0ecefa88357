"""Analogs for sources the fixture specification does not cover, in the same style (SQL for the oracle).

The Spark side of each lives in ``trestle.sources.analogs``.
"""

from trestle.plans.form_maps import (INCIDENT_COLUMNS, OPPORTUNITY_BOOLEANS, OPPORTUNITY_COLUMNS, OPPORTUNITY_NUMBERS,
                                     OPPORTUNITY_TIMES, OSHA_COLUMNS, PRACTICE_AREA_COLUMNS, snake)

EXTRA_SQL: dict[str, str] = {
    # AP lines (APTL): one line per lineitem, same company/job coding as the job-cost analog.
    "fx_ap_line": """
select cast(l_linenumber % 2 + 1 as string) as apco, cast(date_trunc('month', l_shipdate) as date) as mth,
  l_orderkey as aptrans, l_linenumber as apline, cast(l_linenumber % 2 + 1 as string) as jcco,
  ' ' || cast(l_suppkey % 40 + 123000 as string) || '. ' as job,
  cast(floor(l_extendedprice * 20) as bigint) as gross_cents, cast(floor(l_extendedprice * 2) as bigint) as retainage_cents
from lineitem
""",
    # AP payment details (APTD): a quarter of the lines have none; open lines have no paid date.
    "fx_ap_pay": """
select cast(l_linenumber % 2 + 1 as string) as apco, cast(date_trunc('month', l_shipdate) as date) as mth,
  l_orderkey as aptrans, l_linenumber as apline,
  case when l_linestatus = 'F' then cast(l_shipdate as date) + 30 end as paid_date,
  cast(floor(l_extendedprice * 20) as bigint) as amount_cents
from lineitem where l_orderkey % 4 <> 0
""",
    # AR transactions (ARTH): one per order, contract coding as the change-item analog.
    "fx_ar": """
select cast(o_custkey % 2 + 1 as string) as arco, cast(date_trunc('month', o_orderdate) as date) as mth,
  o_orderkey as artrans, cast(o_custkey % 2 + 1 as string) as jcco, cast(o_custkey % 100 + 123000 as string) || '.' as contract,
  cast(floor(o_totalprice * 100) as bigint) as invoiced_cents, cast(floor(o_totalprice * 60) as bigint) as paid_cents,
  cast(floor(o_totalprice * 5) as bigint) as retainage_cents
from orders
""",
    # Opportunity -> office division assignments.
    "fx_office_division": """
select user_id % 5 + 1 as office_division_id,
  case user_id % 5 when 0 then 'Midwest' when 1 then 'Great Lakes' when 2 then 'Mid-Atlantic' when 3 then 'Central' else 'West' end
    as office_division_description,
  user_id as opportunity_id, ts as last_load_dt
from events
""",
    # Practice areas.
    "fx_practice_area": """
select p_partkey % 4 + 1 as practice_area_id,
  case p_partkey % 4 when 0 then 'Education' when 1 then 'Healthcare' when 2 then 'Industrial' else 'Water Resources' end
    as practice_area_name
from part
""",
    # GL segment names (GLPI).
    "fx_segment": """
select * from (select distinct glco, 1 as partno, part1 as instance, 'Account ' || part1 as description from fx_gl where part1 <> '88200')
union all
select * from (select distinct glco, 2 as partno, part2 as instance, 'Division ' || part2 as description from fx_gl where part2 <> '0000')
union all
select * from (select distinct glco, 3 as partno, part3 as instance,
  case when part3 in ('300', '311') then 'Region Dept ' else 'Dept ' end || part3 as description from fx_gl where part3 <> '000')
""",
    # WIP spreadsheet rows of all files.
    "fx_wip_sheet": """
select 'sheet_' || lower(o_orderstatus) as sheet_name, cast(o_custkey + 123000 as string) || '.' as job_number,
  'Job ' || cast(o_custkey as string) as job_description, o_orderpriority as region,
  cast(floor(o_totalprice / 1000) as bigint) as revenue_backlog, cast(floor(o_totalprice) as bigint) as ytd_revenue,
  case when o_orderkey % 5 = 0 then 'False' else 'True' end as include_job
from orders
""",
    # CRM child tables: practice areas, delivery methods, debrief flags, units of measure per opportunity.
    "fx_opp_practice_area": """
select user_id as opportunity_id, event_id % 4 + 1 as practice_area_id,
  case event_id % 4 when 0 then 'Education' when 1 then 'Healthcare' when 2 then 'Industrial' else 'Water' end as practice_area_name,
  cast(ts as date) as last_load_dt
from events
""",
    "fx_opp_delivery_method": """
select user_id as opportunity_id,
  event_id % 3 + 1 as delivery_method_id,
  case event_id % 3 when 0 then 'Design-Build' when 1 then 'CM at Risk' else 'Hard Bid' end as delivery_method_name,
  cast(ts as date) as last_load_dt
from events
""",
    "fx_opp_debrief": """
select user_id as opportunity_id, case event_id % 3 when 0 then 'Yes' when 1 then 'no' else 'n/a' end as debrief_text,
  ts as last_load_dt
from events
""",
    "fx_opp_uom": """
select user_id as opportunity_id, case when event_id % 2 = 0 then 'SF' else 'LF' end as unit_of_measure, ts as last_load_dt
from events
""",
}
# Rule tables.  A rule with a smaller priority wins; the names follow the account text.
EXTRA_SQL |= {
    "fx_rule_line": """
select * from (values
  (1, '89', 'other'), (1, '88200', 'other'), (1, '88300', 'other'), (1, '88400', 'other'),
  (2, '41010', 'construction_revenue'), (2, '41020', 'construction_revenue'), (2, '41030', 'construction_revenue'),
  (2, '5', 'direct_construction_cost'), (2, '6', 'indirect_construction_cost'), (2, '7', 'indirect_construction_cost'),
  (2, '8', 'admin_expenses')) as r(priority, prefix, line)
""",
    "fx_excluded_company": """
select unnest(['41', '47', '51', '54', '56', '58', '61', '64', '67', '120', '122', '124', '126', '128', '130', '132', '134']) as glco
union all
select cast(n as varchar) from generate_series(71, 104) as g(n)
""",
    "fx_rule_admin": """
select unnest(areas) as area, dept, category from (
  select areas, unnest(depts) as dept, category from (values
    (['0000'], ['309', '009'], 'Accounting'), (['0000'], ['414', '014'], 'Business Development'),
    (['0000'], ['012', '312'], 'HR'), (['0000'], ['407', '007'], 'Project Solutions'),
    (['0000'], ['316', '016'], 'Risk Management'), (['0000'], ['000', '300'], 'C-Suite'),
    (['0400', '0600', '0800', '1200'], ['300', '010'], 'Project Support'),
    (['0400', '0600', '0800', '1200'], ['004'], 'Facilities'),
    (['0000', '0400', '0600', '0800', '1200'], ['302', '002'], 'Field Ops'),
    (['0000', '0400', '0600', '0800', '1200'], ['311', '011'], 'Safety'),
    (['0000', '0400', '0600', '0800', '1200'], ['008', '108', '308', '408', '508'], 'Technology'),
    (['0400'], ['000', '100', '106', '400', '500'], 'Great Lakes'), (['0600'], ['000', '100', '106', '400', '500'], 'Central'),
    (['0800'], ['000', '100', '106', '400', '500'], 'Mid-Atlantic'), (['1200'], ['000', '100', '106', '400', '500'], 'Midwest')
  ) as r(areas, depts, category))
""",
    # Grade bands closed below and open above.
    "fx_band": """
select * from (values
  ('high_float', 0, 3, 'A'), ('high_float', 3, 5, 'B'), ('high_float', 5, 10, 'C'), ('high_float', 10, 15, 'D'),
  ('tfci', 1, 1e300, 'A'), ('tfci', .97, 1, 'B'), ('tfci', .95, .97, 'C'), ('tfci', .9, .95, 'D'),
  ('cpli', 1, 1e300, 'A'), ('cpli', .95, 1, 'B'), ('cpli', .9, .95, 'C'), ('cpli', .85, .9, 'D')
) as b(metric, low, below, grade)
""",
}
# Grade limits.  The nearest limit that a value keeps gives the grade; a value that keeps none is an F.
EXTRA_SQL |= {
    "fx_grade_upto": """
select metric, cast(bound as double) as bound, grade from (values
  ('invalid_dates', 0, 'A'), ('invalid_dates', 2, 'B'), ('invalid_dates', 3, 'c'), ('invalid_dates', 5, 'D'),
  ('lags', 2, 'A'), ('lags', 4, 'B'), ('lags', 6, 'C'), ('lags', 8, 'D'), ('leads', 0, 'A'), ('leads', 1, 'D'),
  ('missing_logic', 4, 'A'), ('missing_logic', 7, 'B'), ('missing_logic', 10, 'C'), ('missing_logic', 15, 'D'),
  ('long_duration', 1, 'A'), ('long_duration', 2, 'B'), ('long_duration', 3, 'C'), ('long_duration', 4, 'D')
) as g(metric, bound, grade)
""",
    "fx_grade_below": """
select metric, cast(bound as double) as bound, grade from (values
  ('soft_constraints', 4, 'A'), ('soft_constraints', 5, 'B'), ('soft_constraints', 6, 'C'), ('soft_constraints', 7, 'D'),
  ('out_of_sequence', 1, 'A'), ('out_of_sequence', 9, 'B'), ('out_of_sequence', 15, 'C'), ('out_of_sequence', 20, 'D')
) as g(metric, bound, grade)
""",
    "fx_grade_from": """
select metric, cast(bound as double) as bound, grade from (values
  ('fs_relationships', 95, 'A'), ('fs_relationships', 90, 'B'), ('fs_relationships', 85, 'C'), ('fs_relationships', 80, 'D'),
  ('bei', 1, 'A'), ('bei', .95, 'B'), ('bei', .9, 'C'), ('bei', .85, 'D'),
  ('missed_activities', 100, 'A'), ('missed_activities', 95, 'B'), ('missed_activities', 90, 'C'), ('missed_activities', 85, 'D')
) as g(metric, bound, grade)
""",
}
# Lookups: accounts, budget codes, phase and cost-type names, each with some entries absent.
EXTRA_SQL |= {
    "fx_account": """
select *, 'Account ' || glacct as description, case left(part1, 1) when '4' then 'I' when '1' then 'A' else 'E' end as acct_type
from (
  select distinct glco, part1 || '.' || part2 || '.' || part3 as glacct, part1, part2, part3 from fx_gl
  union
  select distinct gl_co, gl_account, split_part(gl_account, '.', 1), split_part(gl_account, '.', 2), '' from fx_budget)
where not (part1 = '61000' and cast(glco as int) % 13 = 0)
""",
    "fx_budget_code": """
select distinct gl_co as glco, budget_code, 'Budget ' || budget_code as description from fx_budget where cast(gl_co as int) % 11 <> 0
""",
    "fx_phase_name": """
select distinct jcco, job, phase_group, phase, 'Phase ' || left(phase, 6) as description from fx_job_cost where phase not like '80%'
""",
    "fx_cost_type": """
select distinct phase_group, cost_type, case cost_type when '1' then 'Labor' when '2' then 'Material' else 'Subcontract' end as name
from fx_job_cost where cost_type <> '4'
""",
}
EXTRA_DEPS: dict[str, list[str]] = {"fx_segment": ["fx_gl"], "fx_account": ["fx_gl", "fx_budget"],
                                    "fx_budget_code": ["fx_budget"], "fx_phase_name": ["fx_job_cost"],
                                    "fx_cost_type": ["fx_job_cost"]}


# Wide staging tables as they come out, typed and under their output names.  The values follow the specification of the
# forms: text by column number and row, unless a column has a value of its own.
def _wide(columns, given: dict[str, str], key: str, value=None) -> str:
    out = []
    for i, (source, name) in enumerate(columns):
        text = f"'{source} ' || cast({key} % {i + 5} as varchar)"
        filled = f"case when ({key} + {i}) % 11 <> 0 then {(value and value(i, source)) or text} end"
        out.append(f"{given.get(source, filled)} as {name}")
    return ", ".join(out)


def _opportunity_value(i: int, c: str) -> str | None:
    if c in OPPORTUNITY_NUMBERS:
        text = f"cast(event_id * {i + 7} % 100000 as varchar) || case event_id % 3 when 0 then '' when 1 then '.5' else '.25' end"
        return f"cast(try_cast({text} as decimal(38,0)) as bigint)"
    if c in OPPORTUNITY_TIMES:
        return f"cast(date '1996-01-01' + cast(event_id * {i + 3} % 1500 as int) as timestamp) + interval 510 minute"
    if c in OPPORTUNITY_BOOLEANS:
        return f"(event_id + {i}) % 9 = 0"
    return None


_DAY = "cast(cast(ts as date) as timestamp)"
_LINK = "'http://x/' || cast(event_id as varchar)"
EXTRA_SQL |= {
    "fx_opportunity_typed": "select event_id as version_id, " + _wide(
        [(c, snake(c)) for c in OPPORTUNITY_COLUMNS], {
            "OpportunityId": "user_id", "OpportunityNumber": "user_id",
            "Size": "cast(try_cast(cast(value as varchar) as decimal(38,0)) as bigint)",
            "StageType": "case event_type when 'purchase' then 'Closed Won' when 'error' then 'Closed Lost' when 'view' then 'Open' "
                         "when 'click' then 'Pending' else 'Lead' end",
            "DeleteRecord": "event_id % 9 = 0", "ClientName": "'Client ' || cast(user_id % 97 as varchar)",
            "NextAction": "'<p class=\"n\">Call&nbsp;' || cast(event_id % 9 + 1 as varchar) || '</p><br/>'",
            "LastModifiedDateTime": "case when event_id % 13 <> 0 then ts end",
            "Note": "'<div>Note&nbsp;' || cast(event_id % 7 as varchar) || '</div>'"},
        "event_id", _opportunity_value) + " from events",
    "fx_incident_typed": "select " + _wide(INCIDENT_COLUMNS.items(), {
        "link": _LINK, "date": f"{_DAY} + interval 495 minute", "report number": "cast(event_id as varchar)",
        "hhoa45b9lwo3l2pp": "'Region ' || cast(user_id % 5 as varchar)",
        "3nmr0xeq7vfwu8fp": "if(event_id % 3 = 0, 'Near Miss', 'Injury')",
        # the hours 1 to 12 with AM or PM: 12 is the first hour of its half day
        "zg69dpnrgww804oa": f"{_DAY} + to_minutes(cast((event_id % 12 + 1) % 12 * 60 + 15 + event_id % 2 * 720 as bigint))"},
        "event_id") + " from events where event_type = 'error' and event_id % 50 <> 0",
    "fx_osha_typed": "select " + _wide(OSHA_COLUMNS.items(), {
        "link": _LINK, "date": f"{_DAY} + interval 495 minute", "updated": f"{_DAY} + interval 18 hour",
        "oshalogincidentdate": _DAY, "oshalogperiodstransferred": "case when event_id % 6 <> 0 then cast(event_id % 30 as varchar) end",
        **{c: f"cast(date '1970-01-01' + cast(event_id * {n} % 9000 as int) as timestamp)" for c, n in (
            ("oshalogreportdate", 3), ("oshalogempbirthdate", 5), ("oshalogemphireddate", 7))},
        **{f"select-{c}": f"if(event_id % {n} = 0, 'true', 'false')" for c, n in (
            ("days away from work", 4), ("job transfer or restriction", 5), ("death", 97), ("other recordable case", 2))}},
        "event_id") + " from events where event_type = 'error' and event_id % 50 <> 0",
    "fx_practice_area_typed": "select " + _wide(PRACTICE_AREA_COLUMNS.items(), {
        "practiceareaid": "p_partkey % 4 + 1",
        "practiceareaname": "case p_partkey % 4 when 0 then 'Education' when 1 then 'Healthcare' when 2 then 'Industrial' "
                            "else 'Water Resources' end",
        "createdate": "cast(date '1996-01-01' + cast(p_partkey % 900 as int) as timestamp) + interval 12 hour"},
        "p_partkey") + " from part",
}
