"""General-ledger marts: P&L lines, company inclusion, monthly revenue (R-45, R-48, R-49 building blocks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.functions import case_rules, include_company, like_any
from trestle.plans import rules_gl as R
from trestle.plans.registry import query
from trestle.sources.tables import Tables

#: Year cutoffs of the marts (the production values are 2017 / 2020 / 2023; the test data is older).
GL_SINCE_YEAR = 1997
INDIRECT_BREAK_YEAR = 1999


def pl_line_item(glacct: Column, natural_account_number: Column, glco: Column) -> Column:
    """X-20 over the P&L rule table; the cash rule comes last (it tests the parsed account number)."""
    admin = glacct.startswith(R.ADMIN_PREFIX) & ~like_any(glacct, [p + "%" for p in R.ADMIN_EXCLUDED_PREFIXES])
    lo, hi = R.CASH_RANGE
    cash = (natural_account_number.between(lo, hi) & ~natural_account_number.isin(*R.CASH_EXCLUDED_ACCOUNTS)
            & ~glco.isin(*R.CASH_EXCLUDED_COMPANIES))
    return case_rules([
        (like_any(glacct, [p + "%" for p in R.REVENUE_PREFIXES]), "construction_revenue"),
        (like_any(glacct, [p + "%" for p in R.DIRECT_COST_PREFIXES]), "direct_construction_cost"),
        (like_any(glacct, [p + "%" for p in R.INDIRECT_COST_PREFIXES]), "indirect_construction_cost"),
        (admin, "admin_expenses"),
        (cash, "cash"),
    ], "other")


def company_included(glco: Column) -> Column:
    lo, hi = R.EXCLUDED_COMPANY_RANGE
    return include_company(glco, R.EXCLUDED_COMPANIES, lo, hi)


def gl_lines(t: Tables, since_year: int = GL_SINCE_YEAR) -> DataFrame:
    """GL summary rows since ``since_year`` with account text, P&L line and company flag."""
    g = t.fx.gl
    # ``year(mth) >= Y`` written as a date range so the parquet reader can skip row groups (pushed filter)
    g = g.filter(F.col("mth") >= F.lit(f"{since_year}-01-01").cast("date"))
    glacct = F.concat_ws(".", "part1", "part2", "part3")
    nat = F.when(F.col("part1") == "", 0).otherwise(F.col("part1").try_cast("int"))
    return (g.withColumn("glacct", glacct)
            .withColumn("natural_account_number", nat)
            .withColumn("pl_line_item", pl_line_item(F.col("glacct"), F.col("natural_account_number"), F.col("glco")))
            .withColumn("include_company", company_included(F.col("glco"))))


# Output columns of the monthly P&L: (name, P&L line, sign).  Revenue is credit-signed in the ledger.
PL_MEASURES = (
    ("revenue_cents", "construction_revenue", -1),
    ("direct_cost_cents", "direct_construction_cost", 1),
    ("indirect_cost_cents", "indirect_construction_cost", 1),
    ("admin_cents", "admin_expenses", 1),
    ("cash_cents", "cash", 1),
    ("other_cents", "other", 1),
)


@query("revenue_by_month")
def revenue_by_month(t: Tables, since_year: int = GL_SINCE_YEAR) -> DataFrame:
    """Flagship: monthly P&L of the included companies, one pass of conditional sums (A-2) per month.

    Plan: parquet scan (4 columns) -> project -> partial hash aggregate -> exchange on ``mth`` (a few hundred
    groups) -> final aggregate.  The year filter is on a derived month column, so it is evaluated right after
    the scan; everything stays in one codegen stage per side of the single shuffle.
    """
    g = gl_lines(t, since_year).filter(F.col("include_company") == 1)
    return g.groupBy("mth").agg(*[
        F.sum(F.when(F.col("pl_line_item") == line, F.col("netamt_cents") * sign).otherwise(0)).alias(name)
        for name, line, sign in PL_MEASURES
    ])


# --- general-ledger marts ---------------------------------------------------------------------------------------
def _segment_names(t: Tables, partno: int, name: str) -> DataFrame:
    s = t.fx.segment.filter(F.col("partno") == partno)
    return s.select(F.trim("instance").alias("_inst"), F.trim("glco").alias("_co"),
                    F.trim("description").alias(name)).distinct()


def _accounts(t: Tables) -> DataFrame:
    return t.fx.account.select(F.trim("glco").alias("_aco"), F.trim("glacct").alias("_acct"),
                               F.col("description").alias("account_description"), F.col("acct_type").alias("account_type"))


def _divisions(t: Tables) -> DataFrame:
    return t.fx.dept.select(F.trim("department").alias("_dept"), F.trim("glco").alias("_dco"),
                            F.trim("description").alias("_div_desc")).distinct()


@query("gl_account_summary")
def gl_account_summary(t: Tables) -> DataFrame:
    """R-24: GL summary + account segments + the three segment names, amounts and months kept as text.

    Rows without a part-1 or part-3 name are dropped (outer joins made inner by their WHERE, P-11); the
    division name comes from the department table, else from the part-2 name.
    """
    g = t.fx.gl.select(F.trim("glco").alias("gl_co"), F.concat_ws(".", "part1", "part2", "part3").alias("gl_account"),
                       F.col("part1").alias("natural_account"), F.col("part2").alias("account_division"),
                       F.col("part3").alias("account_department"), F.trim(F.col("mth").cast("string")).alias("mth"),
                       F.trim(F.col("netamt_cents").cast("string")).alias("net_amount"), F.trim("jrnl").alias("jrnl"),
                       F.trim("glref").alias("gl_ref"), F.trim("sourceco").alias("source_co"), F.trim("source").alias("source"))
    dm = t.fx.dept.select(F.trim("department").alias("_dept"), F.trim("glco").alias("_dco"),
                          F.col("description").alias("_dm_desc"))
    p2 = t.fx.segment.filter(F.col("partno") == 2).select(
        F.trim("instance").alias("_i2"), F.col("glco").alias("_c2"), F.col("description").alias("_p2_desc"))
    p1 = t.fx.segment.filter(F.col("partno") == 1).select(
        F.trim("instance").alias("_i1"), F.trim("glco").alias("_c1"), F.col("description").alias("natural_account_desc"))
    p3 = t.fx.segment.filter(F.col("partno") == 3).select(
        F.trim("instance").alias("_i3"), F.trim("glco").alias("_c3"), F.col("description").alias("department_description"))
    ac = _accounts(t)
    g = g.join(ac, (g.gl_co == ac._aco) & (g.gl_account == ac._acct), "left")
    j = (g.join(dm, (F.trim(g.account_division) == dm._dept) & (F.trim(g.gl_co) == dm._dco), "left")
         .join(p2, (F.trim(g.account_division) == p2._i2) & (g.gl_co == p2._c2), "left")
         .join(p1, (g.natural_account == p1._i1) & (g.gl_co == p1._c1), "inner")
         .join(p3, (g.gl_co == p3._c3) & (g.account_department == p3._i3), "inner"))
    return j.select("gl_co", "gl_account", "account_description", "account_type", "natural_account", "natural_account_desc", "account_division",
                    F.coalesce("_dm_desc", "_p2_desc").alias("division_description"), "account_department",
                    "department_description", "jrnl", "gl_ref", "source_co", "source", "mth", "net_amount")


@query("gl_segments_required")
def gl_segments_required(t: Tables) -> DataFrame:
    """P-11: GL rows kept only when both the part-1 and the part-3 segment have a name."""
    g = t.fx.gl
    p1 = _segment_names(t, 1, "natural_account_desc")
    p3 = _segment_names(t, 3, "department_description")
    j = (g.join(p1, (g.part1 == p1._inst) & (g.glco == p1._co), "inner")
         .join(p3, (g.part3 == p3._inst) & (g.glco == p3._co), "inner"))
    return j.groupBy("glco", "part1", "part3", "natural_account_desc", "department_description").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("netamt_cents").alias("netamt_cents"))


def admin_category(division: Column, department: Column) -> Column:
    return case_rules([(division.isin(*divs) & department.isin(*depts), label)
                       for divs, depts, label in R.ADMIN_CATEGORIES], None)


def indirect_flag(pl: Column, division: Column, year: Column, break_year: int) -> Column:
    ind = pl == "indirect_construction_cost"
    return (F.when(ind & division.isin(*R.INDIRECT_DIVISIONS) & (year >= break_year), 1)
            .when(ind & (year <= break_year - 1), 1).otherwise(0))


def gl_flagged(t: Tables, since_year: int = GL_SINCE_YEAR, break_year: int = INDIRECT_BREAK_YEAR) -> DataFrame:
    """Ledger lines with P&L line, company flag, region, market and indirect-cost flag, without the segment names:
    what the monthly marts add up.  The region/market dimension is joined as is (see :func:`gl_actuals`)."""
    from trestle.plans.dimensions import dim_region_market

    rm = dim_region_market(t).select(F.col("department").alias("_rm_dept"), "region", "market")
    g = gl_lines(t, since_year)
    return g.join(rm, g.part2 == rm._rm_dept, "left").withColumn(
        "use_indirect_cost", indirect_flag(F.col("pl_line_item"), F.col("part2"), F.year("mth"), break_year))


@query("gl_actuals")
def gl_actuals(t: Tables, since_year: int = GL_SINCE_YEAR, break_year: int = INDIRECT_BREAK_YEAR) -> DataFrame:
    """R-45/R-66: GL since ``since_year`` + segments and names, P&L line, company flag, region/market,
    indirect-cost flag, admin category and 'Other' defaults.

    The lookups (departments, segment names) are made distinct before joining; the region/market dimension is
    joined as is (a department listed for two companies duplicates ledger rows, as in the reference).
    """
    g = gl_flagged(t, since_year, break_year)
    ac = _accounts(t)
    g = g.join(ac, (g.glco == ac._aco) & (g.glacct == ac._acct), "left")
    div = _divisions(t)
    p1 = _segment_names(t, 1, "natural_account_desc")
    p2 = _segment_names(t, 2, "_p2_desc")
    p3 = _segment_names(t, 3, "department_description")
    j = (g.join(div, (g.glco == div._dco) & (g.part2 == div._dept), "left")
         .join(p1, (g.glco == p1._co) & (g.part1 == p1._inst), "left").drop("_co", "_inst")
         .join(p2, (g.glco == p2._co) & (g.part2 == p2._inst), "left").drop("_co", "_inst")
         .join(p3, (g.glco == p3._co) & (g.part3 == p3._inst), "left").drop("_co", "_inst"))
    j = j.withColumns({
        "division_description": F.coalesce("_div_desc", "_p2_desc"),
        "account_division_number": F.when(F.col("part2") == "", 0).otherwise(F.col("part2").try_cast("int")),
    })
    j = j.withColumns({
        "admin_expense_category": F.when(F.col("pl_line_item") == "admin_expenses",
                                         admin_category(F.col("part2"), F.col("part3"))),
        "region_clean": F.ifnull("region", F.lit("Other")),
        "market_clean": F.ifnull("market", F.lit("Other")),
    })
    return j.select("glco", "glacct", "account_description", "account_type", "mth", "netamt_cents", F.col("part1").alias("natural_account"),
                    F.col("part2").alias("account_division"), F.col("part3").alias("account_department"),
                    "natural_account_desc", "division_description", "department_description",
                    "account_division_number", "natural_account_number", "pl_line_item", "include_company",
                    "region", "market", "use_indirect_cost", "admin_expense_category", "region_clean", "market_clean",
                    F.concat("region_clean", F.lit(" - "), "market_clean").alias("region_market_clean"))


@query("gl_budget")
def gl_budget(t: Tables, break_year: int = INDIRECT_BREAK_YEAR, combined: bool = False) -> DataFrame:
    """R-46/R-67: plan and forecast budget versions.

    Lines of another year than their budget code are '<year> Plan' (newest FC number per account, name and
    month); same-year lines are '<year> FC<round(n)>' and keep, per name and FC base (floor), the highest FC
    number.  FC numbers compare as text (D12), so '9' beats '10'.  Lines whose code has no FC number get a NULL
    name and vanish.  The Plan pick is arbitrary in the reference; company, code and amount break its ties.

    ``combined``: FC lines of a company, account, code and month come as one row with their sum, for callers that add
    them up; the plan lines are the same.
    """
    from trestle.plans.dimensions import dim_region_market
    from trestle.plans.finance import budget_parsed

    u = budget_versions(budget_parsed(t, combined=combined))
    u = u.withColumns({
        "account_division_number": F.when(F.col("account_division") == "", 0)
        .otherwise(F.col("account_division").try_cast("int")),
        "pl_line_item": pl_line_item_budget(F.col("gl_account")),
        "include_company": company_included(F.col("gl_co")),
    })
    rm = dim_region_market(t).select(F.col("department").alias("_rm_dept"), "region", "market")
    u = u.join(rm, u.account_division == rm._rm_dept, "left")
    u = u.withColumns({
        "use_indirect_cost": indirect_flag(F.col("pl_line_item"), F.col("account_division"),
                                           F.col("budget_year").try_cast("int"), break_year),
        "region_clean": F.ifnull("region", F.lit("Other")),
        "market_clean": F.ifnull("market", F.lit("Other")),
    })
    return u.select("gl_co", "gl_account", "mth", "natural_account", "account_division", "account_department",
                    "department_description", "budget_code", "budget_year", "fc_number", "budget_cents",
                    "budget_name", "mth_year", "budget_type", "account_division_number", "pl_line_item",
                    "include_company", "use_indirect_cost", "region", "market", "region_clean", "market_clean",
                    F.concat("region_clean", F.lit(" - "), "market_clean").alias("region_market_clean"))


def pl_line_item_budget(acct: Column) -> Column:
    """The budget's P&L rule list has no cash line."""
    admin = acct.startswith(R.ADMIN_PREFIX) & ~like_any(acct, [p + "%" for p in R.ADMIN_EXCLUDED_PREFIXES])
    return case_rules([
        (like_any(acct, [p + "%" for p in R.REVENUE_PREFIXES]), "construction_revenue"),
        (like_any(acct, [p + "%" for p in R.DIRECT_COST_PREFIXES]), "direct_construction_cost"),
        (like_any(acct, [p + "%" for p in R.INDIRECT_COST_PREFIXES]), "indirect_construction_cost"),
        (admin, "admin_expenses"),
    ], "other")


def budget_versions(b: DataFrame) -> DataFrame:
    """Name each budget line ('<year> Plan' / '<year> FC<n>') and keep the selected versions (see gl_budget).

    Plan: newest FC number (text order, NULL first) per (account, name, month), one row (W-1).  The filter is a
    pure ``row_number() = 1``, so Spark inserts a map-side group limit before the shuffle and a hot
    (account, name, month) key never reaches one task whole.
    FC: rows whose FC number is the text-greatest of its (name, floor) group.  The group maxima are a small
    aggregate (one row per budget version, partial aggregation map-side) joined back on (name, FC number);
    AQE broadcasts it once its runtime size is known to be under the threshold.
    """
    from trestle.operators.windows import latest_per_key

    b = named_budget(b)
    plan = b.filter(F.col("budget_type") == "Plan")
    if "least_cents" in b.columns:                # combined lines: the one that would be first among them
        plan, b = plan.withColumn("budget_cents", F.col("least_cents")).drop("least_cents"), b.drop("least_cents")
    plan = latest_per_key(plan, ["gl_account", "budget_name", "mth"],
                          ["fc_number"], tie=[F.col("gl_co").asc(), F.col("budget_code").asc(),
                                              F.col("budget_cents").asc()])
    return plan.unionByName(forecast_versions(b))


def named_budget(b: DataFrame) -> DataFrame:
    """Budget lines with ``budget_name``, ``mth_year`` and ``budget_type``."""
    mth_year = F.year("mth")
    fc_round = F.round(F.col("fc_number").try_cast("double")).cast("bigint").cast("string")
    name = F.when(F.col("budget_year").try_cast("int") != mth_year,
                  F.concat(mth_year.cast("string"), F.lit(" Plan"))).otherwise(
        F.concat(F.col("budget_year"), F.lit(" FC"), fc_round))
    b = b.withColumns({"budget_name": name, "mth_year": mth_year})
    return b.withColumn("budget_type", F.when(F.col("budget_name").like("%Plan%"), "Plan")
                        .when(F.col("budget_name").like("%FC%"), "FC"))


def forecast_versions(named: DataFrame) -> DataFrame:
    """The FC part of :func:`budget_versions`."""
    fc = named.filter(F.col("budget_type") == "FC")
    fc_max = (fc.groupBy(F.col("budget_name").alias("_bn"), F.floor(F.col("fc_number").try_cast("double")).alias("_base"))
              .agg(F.max("fc_number").alias("_max_fc")).drop("_base"))
    # fc_max has one row per budget version.  It is not hinted: with the hint the plan measured 2.5x slower,
    # and AQE turns this join into a broadcast once the (tiny) aggregate stage is measured; if it ever stayed a
    # sort-merge join, AQE's skew handling splits the few hot (name, FC number) partitions of the FC side.
    return (fc.join(fc_max, (fc.budget_name == fc_max._bn) & (fc.fc_number == fc_max._max_fc), "inner")
            .drop("_bn", "_max_fc"))
