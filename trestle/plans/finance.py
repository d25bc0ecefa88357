"""Contracts and finances: staging and intermediate models (R-3, R-4, R-15..R-27) and the job dimension (R-55).

Pre-aggregation happens before every join (estimates, costs, receivables and payables are reduced to one row
per company+job first), so the joins of the job dimension are between tables with one row per job.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle import DEFAULT_AS_OF
from trestle.functions import date_lit, div0, first_of_month, month_floor, parse_amount, part, regex_group, shift_date
from trestle.operators import windows as W
from trestle.plans.registry import query
from trestle.sources import control as S
from trestle.sources.landing import land_fresh
from trestle.sources.tables import Tables

AS_OF = DEFAULT_AS_OF
#: Budget history kept from this year on (production: 2017).
BUDGET_SINCE_YEAR = 1996
#: The forecast is carried to the end of the evaluation year.
FORECAST_AS_OF = date(2001, 12, 31)


# --- contracts --------------------------------------------------------------------------------------------------
@query("contract_master")
def contract_master(t: Tables) -> DataFrame:
    """R-15: one row per company + contract; job = contract; start = owner date, else start date, else month."""
    c = t.fx.contract
    start_month = month_floor("start_date")
    return c.select(F.trim("jcco").alias("jcco"), F.trim("contract").alias("contract"),
                    F.trim("contract").alias("job"), "description", start_month.alias("start_month"),
                    F.coalesce("owner_contract_date", "start_date", start_month).alias("start_date"),
                    "orig_contract_cents", "contract_cents", "received_cents", "actual_close_date", "month_closed", "customer",
                    "contract_status")


@query("change_orders")
def change_orders(t: Tables) -> DataFrame:
    """R-16: owner change items left-joined to posted items; pending rule; dedupe on both key ids (W-2)."""
    posted = t.fx.posted_item.select("aco", "aco_item", "jcco", F.col("job").alias("project"),
                                     F.col("key_id").alias("jcoi_key_id"), "approved_month")
    j = t.fx.change_item.join(posted, ["aco", "aco_item", "jcco", "project"], "left")
    approved_unposted = (F.col("approved") == "Y") & F.col("jcoi_key_id").isNull()
    not_approved = F.col("approved") != "Y"
    out = j.select(
        F.col("jcco").alias("pmco"), F.trim("project").alias("project"), F.trim("project").alias("contract"),
        "approved", "approved_date", "approved_cents", "fixed_cents", "approved_month",
        F.col("key_id").alias("pmoi_key_id"), "jcoi_key_id",
        F.when(approved_unposted, True).when(not_approved, True).otherwise(False).alias("is_pending"),
        F.when(approved_unposted, F.col("approved_cents")).when(not_approved, F.col("pending_cents"))
        .otherwise(F.col("fixed_cents")).alias("pending_cents"),
    )
    return W.earliest_per_key(out, ["pmoi_key_id", "jcoi_key_id"], ["approved_date"])


# --- job cost detail slices -------------------------------------------------------------------------------------
@query("cost_nonzero")
def actual_cost(t: Tables) -> DataFrame:
    """R-20/P-3: cost transactions with actual cost <> 0 (NULL cost dropped too)."""
    jc = t.fx.job_cost
    return jc.filter(F.col("actual_cents") != 0).select(
        F.trim("jcco").alias("jcco"), F.trim("job").alias("job"), "mth", "actual_date", "trans_type",
        F.trim("phase_group").alias("phase_group"), F.trim("phase").alias("phase"), "cost_type", "actual_cents")


@query("committed_cost")
def committed_cost(t: Tables) -> DataFrame:
    """R-21: committed cost <> 0; the phase group is not trimmed here."""
    jc = t.fx.job_cost
    return jc.filter(F.col("committed_cents") != 0).select(
        F.trim("jcco").alias("jcco"), F.trim("job").alias("job"), "mth", "actual_date", "trans_type", "phase_group",
        F.trim("phase").alias("phase"), "cost_type", "committed_cents")


@query("cost_estimates")
def cost_estimates(t: Tables) -> DataFrame:
    """R-22: OE/CO -> estimate, PF -> projection; the filter trims the type, the CASE does not."""
    jc = t.fx.job_cost
    tt = F.col("trans_type")
    est = F.when(tt.isin("OE", "CO"), F.col("est_cents")).when(tt == "PF", F.col("proj_cents")).otherwise(0)
    return jc.filter(F.trim(tt).isin("OE", "CO", "PF")).select(
        F.trim("jcco").alias("jcco"), F.trim("job").alias("job"), "mth", "actual_date", "trans_type",
        "phase_group", F.trim("phase").alias("phase"), "cost_type", est.alias("estimated_cents"))


@query("accounts_payable")
def accounts_payable(t: Tables) -> DataFrame:
    """R-18: AP lines left join payment details USING (company, month, transaction, line)."""
    lines = t.fx.ap_line
    pay = t.fx.ap_pay
    j = lines.join(pay, ["apco", "mth", "aptrans", "apline"], "left")
    return j.select(F.trim("apco").alias("apco"), "mth", "aptrans", "apline", F.trim("jcco").alias("jcco"),
                    F.trim("job").alias("job"), "gross_cents", "retainage_cents", "paid_date", "amount_cents")


@query("accounts_receivable")
def accounts_receivable(t: Tables) -> DataFrame:
    """R-19: AR transactions with trimmed keys."""
    a = t.fx.ar
    return a.select(F.trim("arco").alias("arco"), "mth", "artrans", F.trim("jcco").alias("jcco"),
                    F.trim("contract").alias("contract"), "invoiced_cents", "paid_cents", "retainage_cents")


# --- budget -----------------------------------------------------------------------------------------------------
def combined_lines(lines: DataFrame) -> DataFrame:
    """One row for all budget lines of a company, account, code and month: ``budget_cents`` is their sum, ``least_cents``
    the amount of which :func:`trestle.plans.gl.budget_versions` picks a plan line (NULL before all others)."""
    cents = F.col("budget_cents")
    return lines.groupBy("gl_co", "gl_account", "budget_code", "mth").agg(
        F.sum(cents).alias("budget_cents"), F.when(F.count(cents) == F.count(F.lit(1)), F.min(cents)).alias("least_cents"))


def budget_lines(t: Tables, since_year: int = BUDGET_SINCE_YEAR, combined: bool = False) -> DataFrame:
    """Budget lines with the year and FC number of their code, without lookups; ``combined``: :func:`combined_lines`."""
    b = t.fx.budget.filter(F.col("mth") >= F.lit(f"{since_year}-01-01").cast("date"))
    if combined:
        b = land_fresh(combined_lines(b))         # read by the plans, the forecasts and their newest versions
    b = b.withColumns({"budget_year": part("budget_code", " ", 1), "fc_number": regex_group("budget_code", r"FC([0-9.]+)")})
    return b.filter(F.col("budget_year").try_cast("int") >= since_year)


@query("budget_parsed")
def budget_parsed(t: Tables, since_year: int = BUDGET_SINCE_YEAR, combined: bool = False) -> DataFrame:
    """R-23: budget lines + account and budget-code lookups + department; year text and FC number from the code.

    ``budget_year`` and ``fc_number`` stay text (D12: FC numbers order lexicographically downstream); the year
    filter casts the text (D11).
    """
    b = budget_lines(t, since_year, combined)
    dept = t.fx.dept.select(F.trim("department").alias("_dept"), F.trim("glco").alias("_co"),
                            F.col("description").alias("department_description"))
    acct = t.fx.account.select(F.col("glco").alias("_aco"), F.col("glacct").alias("_acct"),
                               F.col("part1").alias("natural_account"), F.col("part2").alias("account_division"),
                               F.col("part3").alias("account_department"), F.col("description").alias("account_description"),
                               F.col("acct_type").alias("account_type"))
    code = t.fx.budget_code.select(F.col("glco").alias("_bco"), F.col("budget_code").alias("_code"),
                                   F.col("description").alias("budget_description"))
    b = (b.join(acct, (b.gl_co == acct._aco) & (b.gl_account == acct._acct), "left")
         .join(code, (b.gl_co == code._bco) & (b.budget_code == code._code), "left"))
    j = b.join(dept, (F.trim(b.account_division) == dept._dept) & (F.trim(b.gl_co) == dept._co), "left")
    return j.select("gl_co", "gl_account", "natural_account", "account_division", "account_department",
                    "account_description", "account_type", "department_description", "budget_code", "budget_description",
                    "budget_year", "fc_number", "mth", "budget_cents", *(["least_cents"] if combined else []))


# --- spreadsheets -----------------------------------------------------------------------------------------------
@query("new_sales_clean")
def new_sales_clean(t: Tables) -> DataFrame:
    """R-3/R-26/R-53: sales files (every listed file, fixed columns), month floor, amounts parsed."""
    u = S.union_controlled(t.fx.control, family=t.fx.sheet, family_key="sheet_name", active_only=False,
                           columns=["month_text", "region", "market_channel", "title", "amount_text", "actual_text"],
                           with_month=False)
    return u.select(first_of_month("month_text").alias("month_date"), "source_table", "region", "market_channel",
                    F.col("title").alias("project"), parse_amount("amount_text").cast("bigint").alias("plan_sales"),
                    parse_amount("actual_text").cast("bigint").alias("actual_sales"))


@query("pending_backlog_clean")
def pending_backlog_clean(t: Tables) -> DataFrame:
    """R-4/R-51: active backlog files; revenue and margin parsed with their two different hyphen rules."""
    u = S.union_controlled(t.fx.control, family=t.fx.sheet, family_key="sheet_name")
    return u.select(first_of_month("month_text").alias("month_date"), "region", "market_channel",
                    F.col("title").alias("project"), "source_table", "file_month_year",
                    parse_amount("amount_text").cast("bigint").alias("pending_backlog_revenue"),
                    parse_amount("amount_text", any_hyphen_null=True).cast("bigint").alias("pending_backlog_margin"))


# --- rolling forecast -------------------------------------------------------------------------------------------
def forecast_totals(t: Tables) -> DataFrame:
    """Region rows summed per (file month, forecast year); the year comes from the leading text."""
    rf = t.fx.forecast.filter(F.col("category_type") == "Region")
    rf = rf.withColumn("forecast_year", part("forecast_type", " ", 1).try_cast("int"))
    return (rf.filter(F.col("forecast_year").isNotNull())
            .groupBy(F.col("file_month").alias("file_month_year"), "forecast_year")
            .agg(F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin")))


@query("forecast_carry_forward")
def forecast_carry_forward(t: Tables, as_of=FORECAST_AS_OF) -> DataFrame:
    """R-25/U-7: actual slices (file year = forecast year) plus the newest file's values carried to each later
    month up to ``as_of``, matched on the forecast year.

    The newest month is a scalar subquery; the carried months are generated per row with ``sequence``.
    """
    totals = forecast_totals(t)
    start = totals.select(month_floor(F.max("file_month_year"))).scalar()
    latest = totals.filter(month_floor("file_month_year") == start)
    last = month_floor(date_lit(as_of))
    carried = (latest.withColumn("_next", F.add_months(month_floor("file_month_year"), 1)).filter(F.col("_next") <= last)
               .select("forecast_year", "revenue", "margin",
                       F.explode(F.sequence(F.col("_next"), last, F.expr("interval 1 month"))).alias("file_month_year"))
               .filter(F.year("file_month_year") == F.col("forecast_year")))
    actual = totals.filter(F.year("file_month_year") == F.col("forecast_year"))
    cols = ["file_month_year", "forecast_year", "revenue", "margin"]
    return actual.select(*cols).union(carried.select(*cols))


# --- job dimension ----------------------------------------------------------------------------------------------
@query("job_dimension")
def job_dimension(t: Tables, as_of=AS_OF, years: int = 10) -> DataFrame:
    """R-55: per job estimates, cost to date, AR/AP balances, change orders, margins and completion.

    Eight inputs are each reduced to one row per (jcco, job) before the joins; the estimate slices come from a
    single pass over the estimates with conditional sums instead of three scans.  One missing input makes the
    dependent measures NULL, as in the reference.  The committed-cost join contributes no column and is dropped.
    """
    cm = contract_master(t)
    ests = cost_estimates(t)
    tt = F.col("trans_type")
    est = ests.groupBy("jcco", "job").agg(
        F.sum(F.when(tt == "OE", F.col("estimated_cents"))).alias("orig_estimate"),
        F.sum(F.when(tt.isin("OE", "CO"), F.col("estimated_cents"))).alias("curr_estimate"),
        F.sum(F.when(tt == "PF", F.col("estimated_cents"))).alias("proj_estimate"))
    ctd = actual_cost(t).groupBy("jcco", "job").agg(F.sum("actual_cents").alias("cost_to_date"))
    co = (change_orders(t).groupBy(F.col("pmco").alias("jcco"), F.col("project").alias("job"))
          .agg(F.sum(F.when(~F.col("is_pending"), F.col("approved_cents")).otherwise(0)).alias("approved_change_orders"),
               F.sum(F.when(F.col("is_pending"), F.col("pending_cents")).otherwise(0)).alias("pending_change_orders")))
    ar = (accounts_receivable(t).groupBy("jcco", F.col("contract").alias("job"))
          .agg((F.sum("invoiced_cents") - F.sum("paid_cents") - F.sum("retainage_cents")).alias("ar_balance"),
               F.sum("invoiced_cents").alias("billed_amt"), F.sum("retainage_cents").alias("current_retain_amt")))
    ap = (accounts_payable(t).filter(F.col("paid_date").isNull())
          .groupBy("jcco", "job").agg(F.sum("amount_cents").alias("ap_balance")))
    h = (cm.join(co, ["jcco", "job"], "left").join(est, ["jcco", "job"], "left").join(ctd, ["jcco", "job"], "left")
         .join(ap, ["jcco", "job"], "left").join(ar, ["jcco", "job"], "left"))
    orig, now = F.col("orig_contract_cents"), F.col("contract_cents")
    r6 = lambda c: F.round(c, 6)
    out = h.select(
        "jcco", "contract", "job", "description", F.concat("job", F.lit(" - "), "description").alias("job_number_name"),
        "start_date", F.coalesce("actual_close_date", "month_closed").alias("close_date"), "customer", "contract_status", orig.alias("orig_contract_amt"), now.alias("contract_amt"), F.col("received_cents").alias("received_amt"), "billed_amt", "current_retain_amt",
        "approved_change_orders", "pending_change_orders",
        (orig - F.col("orig_estimate")).alias("orig_gross_margin"),
        (now - F.col("curr_estimate")).alias("curr_gross_margin"),
        (now - F.col("proj_estimate")).alias("proj_gross_margin"),
        r6(div0(orig - F.col("orig_estimate"), orig)).alias("orig_gross_margin_pct"),
        r6(div0(now - F.col("curr_estimate"), now)).alias("curr_gross_margin_pct"),
        r6(div0(now - F.col("proj_estimate"), now)).alias("proj_gross_margin_pct"),
        F.round(div0("cost_to_date", "curr_estimate") * now, 2).alias("earned_revenue"),
        F.round(F.col("billed_amt") - div0("cost_to_date", "proj_estimate") * now, 2).alias("over_under_billed"),
        "ar_balance", "ap_balance",
        ((F.col("billed_amt") - F.col("ar_balance") - F.col("current_retain_amt"))
         - (F.col("cost_to_date") - F.col("ap_balance"))).alias("cash_flow"),
        "orig_estimate", "curr_estimate", "proj_estimate", "cost_to_date",
        (F.col("proj_estimate") - F.col("cost_to_date")).alias("cost_to_complete"),
        (F.col("curr_estimate") - F.col("proj_estimate")).alias("over_under"),
        r6(div0("cost_to_date", "proj_estimate")).alias("percent_complete"),
    ).distinct()
    return out.filter(F.col("start_date") >= shift_date(date_lit(as_of), -years, "year"))


@query("rolling_forecast_summary")
def rolling_forecast_summary(t: Tables) -> DataFrame:
    """R-5: every active rolling-forecast file (six columns) with provenance (S-2).

    The forecast analog holds the rows of all files; its control table lists one file per file month.
    """
    rows = t.fx.forecast.withColumn("file_name", F.concat(F.lit("rf_"), F.date_format("file_month", "yyyyMM")))
    control = (rows.select(F.col("file_name").alias("table_name"),
                           F.col("file_month").cast("string").alias("file_month_year")).distinct()
               .withColumn("active", F.lit(True)))
    u = S.union_controlled(control, family=rows.drop("file_month"), family_key="file_name")
    return u.select("forecast_type", "category_type", "category", "revenue", "margin",
                    F.round(F.col("margin") / F.col("revenue"), 6).alias("pct_margin"), "source_table",
                    "file_month_year")
