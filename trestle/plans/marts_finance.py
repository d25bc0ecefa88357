"""Finance marts: division budget and actuals (R-47, R-48), revenue metrics (R-49), backlog (R-50, R-27, R-6),
pending backlog and rolling forecast marts (R-51, R-52)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trestle import DEFAULT_AS_OF
from trestle.functions import region_code, safe_div
from trestle.operators import reshape as U
from trestle.plans.gl import (GL_SINCE_YEAR, budget_versions, gl_account_summary, gl_budget, gl_flagged)
from trestle.plans.registry import query
from trestle.sources import control as S
from trestle.sources.landing import land_fresh
from trestle.sources.tables import Tables

# The regional divisions of the budget mart.
REGION_DIVISIONS = ("0400", "0410", "0420", "0430", "0440",
                    "0600", "0610", "0620", "0630", "0640",
                    "0800", "0810", "0820", "0830", "0840",
                    "1200", "1210", "1220", "1230", "1240")
REVENUE_ACCOUNT = "41010"
#: First year of the revenue metrics (production: 2023).
METRICS_SINCE_YEAR = 1999


def _division_cols(df: DataFrame) -> DataFrame:
    return df.withColumns({"region": region_code("account_division"),
                           "division": F.right(F.col("account_division"), F.lit(2))})


@query("division_budget")
def division_budget(t: Tables) -> DataFrame:
    """R-47: selected budget versions of the regional divisions; revenue lines (account 41010) are not
    aggregated, so there is one output row per revenue line, next to the division's total (margin)."""
    from trestle.plans.finance import budget_parsed

    # Read twice below: lines and their totals.
    v = land_fresh(budget_versions(budget_parsed(t).filter(F.col("account_division").isin(*REGION_DIVISIONS))).select(
        "gl_co", "account_division", "department_description", "natural_account", "budget_name", "mth_year", "mth", "budget_cents"))
    margin = (v.groupBy("gl_co", "account_division", "department_description", "budget_name", "mth_year", "mth")
              .agg(F.sum("budget_cents").alias("margin")))
    rev = v.filter(F.col("natural_account") == REVENUE_ACCOUNT).select(
        "gl_co", "account_division", "budget_name", "mth", F.col("budget_cents").alias("revenue"))
    j = rev.join(margin, ["gl_co", "account_division", "budget_name", "mth"], "inner")
    j = _division_cols(j).filter(~F.col("account_division").like("%00"))
    return j.select("gl_co", "account_division", "region", "division", "department_description", "budget_name",
                    "mth_year", "mth", "revenue", "margin")


@query("division_actuals")
def division_actuals(t: Tables, since_year: int = GL_SINCE_YEAR) -> DataFrame:
    """R-48: actual revenue per revenue account next to the division total, for departments named like
    'region'; amounts are text in the summary (D11), months compare as text (D12)."""
    g = gl_account_summary(t).filter(F.lower("department_description").like("%region%"))
    g = g.withColumn("_amt", F.col("net_amount").try_cast("double"))
    keys = ["gl_co", "gl_account", "natural_account", "account_division", "account_department",
            "department_description", "mth"]
    acct = g.groupBy(*keys).agg(F.sum("_amt").alias("net_amount"))
    rev = (acct.filter(F.col("natural_account").like(REVENUE_ACCOUNT + "%"))
           .groupBy(*keys).agg(F.sum("net_amount").alias("revenue")))
    margin = acct.groupBy("gl_co", "account_division", "mth").agg(F.sum("net_amount").alias("margin"))
    j = rev.join(margin, ["gl_co", "account_division", "mth"], "left")
    j = _division_cols(j).filter(~F.col("account_division").like("%00") & (F.col("mth") >= f"{since_year}-01-01"))
    return j.select("gl_co", "account_division", "region", "division", "department_description", "mth",
                    F.round("revenue").cast("bigint").alias("revenue"), F.round("margin").cast("bigint").alias("margin"))


def _pl_sums(df: DataFrame, amount: str, keys: list) -> DataFrame:
    pl = F.col("pl_line_item")
    has_region = F.col("region").isNotNull()
    return df.groupBy(*keys).agg(
        (-1 * F.sum(F.when((pl == "construction_revenue") & has_region, F.col(amount)).otherwise(0))).alias("revenue"),
        F.sum(F.when((pl == "direct_construction_cost") & has_region, F.col(amount)).otherwise(0)).alias("direct_cost"),
        F.sum(F.when((pl == "indirect_construction_cost") & (F.col("use_indirect_cost") == 1), F.col(amount))
              .otherwise(0)).alias("indirect_cost"))


@query("revenue_metrics")
def revenue_metrics(t: Tables, as_of=DEFAULT_AS_OF, since_year: int = METRICS_SINCE_YEAR) -> DataFrame:
    """R-49: monthly revenue, direct and indirect cost and margin in six labelled slices.

    Actual slices (two years back, last year, YTD) are labelled in one pass over the monthly actuals (U-8);
    the plan slices keep the rows of the text-greatest FC number of their slice (W-7).  Budget lines are added up per
    company, account, code and month before their codes are parsed and looked up.
    """
    y = as_of.year
    act = _pl_sums(gl_flagged(t).filter((F.col("include_company") == 1)
                                                     & (F.col("mth") >= F.lit(f"{since_year}-01-01").cast("date"))),
                   "netamt_cents", ["mth"])
    yr = F.year("mth")
    actual = U.labelled_slices(act, {str(y - 2): yr == y - 2, str(y - 1): yr == y - 1, f"{y} YTD": yr == y},
                               label_col="rev_type")
    bud = _pl_sums(gl_budget(t, combined=True).filter((F.col("include_company") == 1)
                                                    & (F.col("mth") >= F.lit(f"{since_year}-01-01").cast("date"))),
                   "budget_cents", ["mth", "budget_type", "budget_name", "fc_number", "mth_year"])
    # The budget slices are labelled in one pass as well; its months and versions are few after the sums.
    plan, fc = F.col("budget_type") == "Plan", (F.col("budget_type") == "FC") & (F.col("mth_year") == y)
    bud = bud.filter((plan & F.col("mth_year").isin(y, y + 1)) | fc)
    newest = F.max("fc_number").over(Window.partitionBy("budget_type", "mth_year"))
    budget = bud.withColumn("_newest", newest).filter(fc | (F.col("fc_number") == F.col("_newest"))).withColumn(
        "rev_type", F.when(fc, F.col("budget_name")).otherwise(F.concat(F.col("mth_year").cast("string"), F.lit(" Plan"))))
    cols = ["mth", "rev_type", "revenue", "direct_cost", "indirect_cost"]
    out = U.stack_rows(*[d.select(*cols) for d in (actual, budget)])
    return out.withColumn("margin", F.col("revenue") - F.col("direct_cost") - F.col("indirect_cost"))


@query("rolling_forecast")
def rolling_forecast(t: Tables) -> DataFrame:
    """R-52/R-70: the carried-forward rolling forecast labelled, with two typed NULL cost columns."""
    from trestle.plans.finance import forecast_carry_forward

    f = forecast_carry_forward(t)
    return f.select(F.col("file_month_year").alias("mth"), F.lit("Rolling Forecast").alias("rev_type"), "revenue",
                    F.lit(None).cast("double").alias("direct_cost"), F.lit(None).cast("double").alias("indirect_cost"),
                    "margin")


@query("pending_backlog_prof")
def pending_backlog_prof(t: Tables) -> DataFrame:
    """R-51/R-69: cleaned pending backlog renamed, amounts as floats."""
    from trestle.plans.finance import pending_backlog_clean

    p = pending_backlog_clean(t)
    return p.select(F.col("month_date").alias("mth"), F.col("region").alias("region_name"),
                    F.col("market_channel").alias("market_name"), "project",
                    F.col("pending_backlog_revenue").cast("double").alias("pending_backlog_revenue"),
                    F.col("pending_backlog_margin").cast("double").alias("pending_backlog_margin"))


@query("wip_union")
def wip_union(t: Tables) -> DataFrame:
    """R-6: every active WIP file, all columns, with provenance."""
    return S.union_controlled(t.fx.control, family=t.fx.wip_sheet, family_key="sheet_name")


@query("project_backlog")
def project_backlog(t: Tables) -> DataFrame:
    """R-27: WIP rows flagged for inclusion (a text comparison with 'True')."""
    w = wip_union(t)
    return w.filter(F.col("include_job") == "True").select(
        "job_number", "job_description", "region", "file_month_year", "revenue_backlog", "ytd_revenue")


@query("backlog_months")
def backlog_months(t: Tables) -> DataFrame:
    """R-50/R-68: backlog x1000 and pending backlog per file month, in months of year-to-date revenue.

    Groups on the raw month text, then casts; a zero YTD revenue gives NULL months (D4) instead of an error.
    """
    b = (project_backlog(t).groupBy("file_month_year")
         .agg((F.sum("revenue_backlog") * 1000).alias("revenue_backlog"), F.sum("ytd_revenue").alias("ytd_revenue"))
         .withColumn("mth", F.col("file_month_year").cast("date")).drop("file_month_year"))
    p = pending_backlog_prof(t).groupBy("mth").agg(F.sum("pending_backlog_revenue").alias("revenue_pending_backlog"))
    j = b.join(p, "mth", "left")
    per_month = safe_div(F.col("ytd_revenue"), F.month("mth"))
    return j.select("mth", F.month("mth").alias("mth_of_year"), "revenue_backlog", "revenue_pending_backlog",
                    "ytd_revenue",
                    F.round(safe_div(F.col("revenue_backlog"), per_month), 6).alias("executed_backlog_months"),
                    F.round(safe_div(F.col("revenue_pending_backlog"), per_month), 6).alias("pending_backlog_months"))


#: Company of the joint-venture view (an argument; the reference hard-codes one company).
JV_COMPANY = "136"
JV_HISTORY_YEARS = 8


@query("joint_ventures")
def joint_ventures(t: Tables, company: str = JV_COMPANY, as_of=DEFAULT_AS_OF, years: int = JV_HISTORY_YEARS) -> DataFrame:
    """R-59: month spine per company with revenue, overbilling and cost (NULL when nothing was posted) and
    their RANGE running sums (NULL until the first value), for one company.

    The company filter sits on the spine; Catalyst pushes it into both sides of the spine/pivot join.
    """
    from trestle.functions import month_floor, shift_date

    g = gl_flagged(t)
    bounds = (g.groupBy("glco").agg(month_floor(F.min("mth")).alias("min_month"), month_floor(F.max("mth")).alias("max_month"))
              .filter(F.col("min_month") >= month_floor(shift_date(F.lit(as_of.isoformat()).cast("date"), -years, "year"))))
    spine = U.month_spine(bounds, F.col("min_month"), F.col("max_month"), out="mth").select("glco", "mth")
    acct = F.col("glacct")
    pivot = g.groupBy("glco", "mth").agg(
        F.sum(F.when(acct.like("41010%"), F.col("netamt_cents"))).alias("contract_revenue"),
        F.sum(F.when(acct.like("41030%"), F.col("netamt_cents"))).alias("overbillings_adjusted"),
        F.sum(F.when(F.col("pl_line_item") == "direct_construction_cost", F.col("netamt_cents"))).alias("cost"))
    j = spine.join(pivot, ["glco", "mth"], "left").filter(F.col("glco") == company)
    from pyspark.sql import Window

    w = Window.partitionBy("glco").orderBy("mth")
    return j.select("glco", "mth", "contract_revenue",
                    F.sum("contract_revenue").over(w).alias("cumulative_contract_revenue"), "overbillings_adjusted",
                    F.sum("overbillings_adjusted").over(w).alias("cumulative_overbillings_adjusted"), "cost",
                    F.sum("cost").over(w).alias("cumulative_cost"))
