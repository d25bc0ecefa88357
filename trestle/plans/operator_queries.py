"""One registered query per generic operator of the inventory (§2.1-§2.8), each on the source analogs.

Every query reads the analogs of the landed tables, so its work grows with the data; none caps or samples rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle import DEFAULT_AS_OF
from trestle.functions import (as_bool, date_lit, as_number, case_rules, contains_ci, days_between, div0, first_of_month,
                               floor_text, like_any, month_diff, month_end, month_floor, parse_amount, parse_ts,
                               part, regex_group, region_code, shift_date, shift_zone, strip_html, trim_text, word)
from trestle.operators import aggregates as A
from trestle.operators import joins as J
from trestle.operators import reshape as U
from trestle.operators import windows as W
from trestle.plans.registry import query
from trestle.sources import control as S
from trestle.sources.tables import Tables, source

AS_OF = DEFAULT_AS_OF


# --- 2.1 scans, sources, sinks ---------------------------------------------------------------------------------
@query("scan_source")
def scan_source(t: Tables) -> DataFrame:
    return t.fx.job_cost


def _sheet_files(t: Tables) -> DataFrame:
    return t.fx.sheet


@query("union_controlled_active")
def union_controlled_active(t: Tables) -> DataFrame:
    return S.union_controlled(t.fx.control, family=_sheet_files(t), family_key="sheet_name")


@query("union_controlled_all")
def union_controlled_all(t: Tables) -> DataFrame:
    return S.union_controlled(t.fx.control, family=_sheet_files(t), family_key="sheet_name", active_only=False)


@query("union_controlled_columns")
def union_controlled_columns(t: Tables) -> DataFrame:
    return S.union_controlled(t.fx.control, family=_sheet_files(t), family_key="sheet_name", active_only=False,
                              columns=["month_text", "region", "title", "amount_text"], with_month=False)


@query("control_latest_load")
def control_latest_load(t: Tables) -> DataFrame:
    latest = S.latest_load(t.fx.control)
    return S.union_controlled(latest, family=_sheet_files(t), family_key="sheet_name", active_only=False, required=True)


@query("control_active_one")
def control_active_one(t: Tables) -> DataFrame:
    one = S.active_table(t.fx.control)
    return S.union_controlled(one, family=_sheet_files(t), family_key="sheet_name", required=True)


@query("drop_header_rows")
def drop_header_rows(t: Tables) -> DataFrame:
    return S.drop_header_rows(t.fx.incident, "link", "Link")


@query("view_roundtrip")
def view_roundtrip(t: Tables) -> DataFrame:
    """S-8: a model registered as a (temporary) view and read back by name."""
    t.fx.contract.createOrReplaceTempView("trestle_contract_master")
    return t.spark.table("trestle_contract_master")


@query("load_window")
def load_window(t: Tables) -> DataFrame:
    e = source(t, "events")
    log = e.select(F.col("ts").alias("last_load_dt"), (F.col("event_type") != "error").alias("success"))
    return S.load_window(log)


# --- 2.2 projections, filters -----------------------------------------------------------------------------------
@query("project_mapping")
def project_mapping(t: Tables) -> DataFrame:
    """P-1: rename/cast projection driven by a column map."""
    return U.project(t.fx.opportunity, {
        "opportunity_version_id": "version_id",
        "opportunity_id": "opportunity_id",
        "last_load_dt": "load_ts",
        "stage_type": "stage_type",
        "delete_record": as_bool("delete_record"),
        "size": as_number(F.col("size_text")).cast("bigint"),
        "market_name": "market_name",
    })


@query("like_rules")
def like_rules(t: Tables) -> DataFrame:
    s = t.fx.sheet
    r = F.col("region")
    return s.select(
        "title", "region",
        r.startswith("1-").alias("is_prefix"),
        r.endswith("LOW").alias("is_suffix"),
        r.contains("NOT").alias("is_contains"),
        contains_ci(r, "Urgent").alias("is_contains_ci"),
        (r == "3-MEDIUM").alias("is_equal"),
        like_any(r, ["2-%", "%SPECIFIED"]).alias("is_any"),
    )


@query("grade_between")
def grade_between(t: Tables) -> DataFrame:
    """P-7: closed BETWEEN bands with overlaps resolved by CASE order; gaps and NULL fall to 'F'."""
    tk = t.fx.task
    days = F.col("total_float_hr_cnt") / 8
    g = case_rules([
        (days > 15, "A"), (days.between(0, 15), "B"), (days.between(-10, -1), "C"), (days.between(-20, -11), "D"),
    ], "F")
    return tk.select("proj_id", "task_id", "start_week", g.alias("float_grade"))


@query("gl_company_filter")
def gl_company_filter(t: Tables) -> DataFrame:
    from trestle.plans.gl import company_included

    g = t.fx.gl
    return (g.groupBy("glco").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("include_company", company_included(F.col("glco"))))


@query("rolling_cutoff")
def rolling_cutoff(t: Tables) -> DataFrame:
    """P-9: ``mth >= month_floor(as_of - 8 years)``."""
    jc = t.fx.job_cost
    cutoff = month_floor(shift_date(date_lit(AS_OF), -8, "year"))
    return (jc.filter(F.col("mth") >= cutoff)
            .groupBy("jcco", "mth").agg(F.sum("est_cents").alias("est_cents")))


@query("latest_week_only")
def latest_week_only(t: Tables) -> DataFrame:
    """P-10: ``start_week = (SELECT max(start_week) ...)`` as a scalar subquery."""
    tk = t.fx.task
    newest = tk.select(F.max("start_week")).scalar()
    return tk.filter(F.col("start_week") == newest).select(
        "proj_id", "task_id", "task_type", "start_week")


# --- 2.3 joins ---------------------------------------------------------------------------------------------------
def _cost_by_contract(t: Tables) -> DataFrame:
    jc = t.fx.job_cost
    return (jc.groupBy("jcco", F.trim("job").alias("contract"))
            .agg(F.sum("est_cents").alias("est_cents"), F.sum("actual_cents").alias("actual_cents")))


@query("join_left_using")
def join_left_using(t: Tables) -> DataFrame:
    con = t.fx.contract.select("jcco", "contract", "description", "orig_contract_cents")
    return J.left_using(_cost_by_contract(t), con, ["jcco", "contract"])


@query("join_left_trimmed")
def join_left_trimmed(t: Tables) -> DataFrame:
    jc = t.fx.job_cost.select("jcco", "job", "phase", "actual_date", "est_cents")
    con = t.fx.contract.select(F.col("jcco").alias("c_jcco"), "contract", "description")
    out = J.left_on(jc, con, {"jcco": "c_jcco", "job": "contract"}, trim=True)
    return out.select("jcco", "job", "phase", "actual_date", "est_cents", "contract", "description")


@query("join_inner")
def join_inner(t: Tables) -> DataFrame:
    ci = t.fx.change_item.select("key_id", "jcco", F.col("project").alias("contract"), "approved_cents")
    con = t.fx.contract.select("jcco", "contract", "description")
    return J.inner(ci, con, ["jcco", "contract"])


@query("join_left_on_const")
def join_left_on_const(t: Tables) -> DataFrame:
    """J-4: right-side constant predicate inside ON: contracts without an approved item are kept."""
    con = t.fx.contract.select("jcco", "contract")
    ci = t.fx.change_item
    approved = ci.filter(F.col("approved") == "Y").select("jcco", F.col("project").alias("contract"), "key_id",
                                                          "approved_cents")
    return J.left_using(con, approved, ["jcco", "contract"])


@query("anti_omit_tagged")
def anti_omit_tagged(t: Tables) -> DataFrame:
    """J-5/R-32: task snapshots minus 'OFG'-tagged tasks; keeps the always-NULL ``short_name`` column."""
    from trestle.plans.schedule import open_grading_tasks

    return open_grading_tasks(t)


@query("cross_params")
def cross_params(t: Tables) -> DataFrame:
    g = t.fx.gl
    params = g.agg(F.max("mth").alias("max_mth"))
    out = J.with_params(g.select("glco", "mth").distinct(), params)
    return out.withColumn("months_behind", month_diff(F.col("mth"), F.col("max_mth")))


@query("month_spine")
def month_spine(t: Tables) -> DataFrame:
    con = t.fx.contract.select("jcco", "contract", "start_date")
    return U.month_spine(con, F.col("start_date"), date_lit(AS_OF), out="month")


@query("trailing_cost")
def trailing_cost(t: Tables) -> DataFrame:
    """J-9: labour cost of the 6 weeks up to each weekly snapshot, by project job key."""
    wk = t.fx.weekly.join(t.fx.project.select("proj_id", "project_name"), "proj_id")
    wk = wk.select("proj_id", "week_ending", F.col("project_name").alias("job_key"))
    jc = t.fx.job_cost.select(part(F.trim("job"), ".", 1).alias("job_key"), "actual_date", "actual_cents")
    out = J.trailing_sums(wk, jc, ["job_key"], "week_ending", "actual_date", "actual_cents", {"cost_6w": 42})
    return out.fillna(0, ["cost_6w"])


@query("pred_status_join")
def pred_status_join(t: Tables) -> DataFrame:
    """J-10: each link with its predecessor's status in the same project and snapshot (inner in effect)."""
    tk = t.fx.task
    links = t.fx.task_pred
    succ = tk.select("proj_id", "task_id", "start_week", "act_start_date")
    pred = tk.select("proj_id", F.col("task_id").alias("pred_task_id"), "start_week",
                     F.col("act_end_date").alias("pred_act_end_date"))
    return (links.select("proj_id", "task_id", "pred_task_id", "pred_type")
            .join(succ, ["proj_id", "task_id"]).join(pred, ["proj_id", "pred_task_id", "start_week"]))


@query("baseline_join")
def baseline_join(t: Tables) -> DataFrame:
    """J-11: current task vs the same task code in the baseline project, same snapshot week."""
    tk = t.fx.task
    proj = t.fx.project.select("proj_id", "baseline_proj_id")
    cur = tk.join(proj, "proj_id").select("proj_id", "baseline_proj_id", "task_id", "task_code", "start_week")
    base = tk.select(F.col("proj_id").alias("baseline_proj_id"), "task_code", "start_week",
                     F.col("task_id").alias("baseline_task_id"),
                     F.col("target_end_date").alias("baseline_target_end_date"))
    return cur.join(base, ["baseline_proj_id", "task_code", "start_week"], "left")


@query("pred_succ_counts")
def pred_succ_counts(t: Tables) -> DataFrame:
    nodes = t.fx.task.select("proj_id", "task_id").distinct()
    return J.link_counts(nodes, t.fx.task_pred, ["proj_id"], "task_id", "pred_task_id")


@query("join_distinct_lookup")
def join_distinct_lookup(t: Tables) -> DataFrame:
    """J-13: the lookup is made distinct before the join so it cannot fan out."""
    divisions = t.fx.dept.select(F.trim("department").alias("part2"), F.trim("glco").alias("glco"),
                                 F.trim("description").alias("division_description")).distinct()
    g = t.fx.gl.select("glco", "part2", "mth", "netamt_cents")
    return g.join(divisions, ["glco", "part2"], "left")


# --- 2.4 aggregations -------------------------------------------------------------------------------------------
@query("group_sum")
def group_sum(t: Tables) -> DataFrame:
    jc = t.fx.job_cost.withColumn("job", F.trim("job"))
    return jc.groupBy("jcco", "job", "phase", "cost_type").agg(
        F.sum("est_cents").alias("est_cents"), F.sum("proj_cents").alias("proj_cents"),
        F.sum("actual_cents").alias("actual_cents"), F.max("mth").alias("last_mth"), F.min("mth").alias("first_mth"))


@query("cond_sum")
def cond_sum(t: Tables) -> DataFrame:
    tk = A.dealt(t.fx.task, ["proj_id", "start_week"])      # a project has few tasks in a week
    return A.cond_sum(tk, ["proj_id", "start_week"], {
        "open_tasks": (F.col("act_end_date").isNull(), 1),
        "milestones": (F.col("task_type").isin("TT_Mile", "TT_FinMile"), 1),
        "hard_constraints": (F.col("cstr_type").isin("CS_MEO", "CS_MSO"), 1),
        "open_float_hours": (F.col("act_end_date").isNull(), F.col("total_float_hr_cnt")),
    })


@query("pivot_cond")
def pivot_cond(t: Tables) -> DataFrame:
    jc = t.fx.job_cost.withColumn("job", F.trim("job"))
    tt = F.col("trans_type")
    return A.pivot_cond(jc, ["jcco", "job"], {
        "oe_cents": tt == "OE", "co_cents": (tt == "CO") & F.col("phase").startswith("05"), "pf_cents": tt == "PF",
    }, "est_cents")


@query("count_distinct_mix")
def count_distinct_mix(t: Tables) -> DataFrame:
    return t.fx.task_pred.groupBy("proj_id").agg(
        F.countDistinct("task_id").alias("n_tasks"), F.countDistinct("pred_task_id").alias("n_preds"),
        F.count(F.lit(1)).alias("n_links"), F.sum("lag_hr_cnt").alias("lag_hours"))


@query("group_count")
def group_count(t: Tables) -> DataFrame:
    return t.fx.task.groupBy("task_type", "start_week").agg(F.count(F.lit(1)).alias("n"))


@query("listagg_distinct")
def listagg_distinct(t: Tables) -> DataFrame:
    return A.listagg_distinct(t.fx.opportunity, ["opportunity_id"], {
        "markets": "market_name", "version_buckets": F.col("version_id") % 5,
        "lead_stages": F.when(F.col("stage_type") == "Lead", F.col("stage_type"))})


@query("global_max")
def global_max(t: Tables) -> DataFrame:
    """A-7/R-33/R-34: newest snapshot week."""
    return A.global_agg(t.fx.task, F.max("start_week").alias("latest_week"))


@query("select_distinct")
def select_distinct(t: Tables) -> DataFrame:
    """A-8/R-17: distinct company, job, cost type, phase group, phase."""
    jc = t.fx.job_cost
    return jc.select(F.trim("jcco").alias("jcco"), F.trim("job").alias("job"), "cost_type",
                     F.trim("phase_group").alias("phase_group"), F.trim("phase").alias("phase")).distinct()


@query("group_dedupe")
def group_dedupe(t: Tables) -> DataFrame:
    return A.dedupe(t.fx.task_tag, ["proj_id", "task_id", "short_name"])


@query("group_two_level")
def group_two_level(t: Tables) -> DataFrame:
    g = t.fx.gl
    first = g.groupBy("glco", "part2", "mth").agg(F.sum("netamt_cents").alias("company_cents"))
    return first.groupBy("part2", "mth").agg(F.sum("company_cents").alias("total_cents"),
                                             F.count(F.lit(1)).alias("n_companies"),
                                             F.max("company_cents").alias("max_company_cents"))


@query("sum_nullif_zero")
def sum_nullif_zero(t: Tables) -> DataFrame:
    from trestle.functions import sum_or_null

    ov = t.fx.override
    return ov.groupBy("jcco", "contract").agg(sum_or_null("proj_over_cost").alias("proj_over_cost"),
                                              sum_or_null("proj_revenue").alias("proj_revenue"))


# --- 2.5 windows ------------------------------------------------------------------------------------------------
@query("latest_per_key")
def latest_per_key(t: Tables) -> DataFrame:
    return W.latest_per_key(t.fx.opportunity, ["opportunity_id"], ["load_ts"], tie=["version_id"])


@query("earliest_per_key")
def earliest_per_key(t: Tables) -> DataFrame:
    return W.earliest_per_key(t.fx.opportunity, ["opportunity_id"], ["load_ts"], tie=["version_id"])


@query("rank_top")
def rank_top(t: Tables) -> DataFrame:
    base = t.fx.task.filter(F.col("proj_id") >= t.fx.BASELINE).select("proj_id", "task_id", "start_week")
    return W.top_rank(base, ["proj_id"], ["start_week"])


@query("global_top1")
def global_top1(t: Tables) -> DataFrame:
    return W.global_top1(t.fx.opportunity, ["load_ts", "version_id"])


def _monthly_phase_cost(t: Tables) -> DataFrame:
    jc = t.fx.job_cost
    return (jc.groupBy("jcco", F.trim("job").alias("job"), "cost_type", "phase_group", "phase", "mth")
            .agg(F.sum("actual_cents").alias("actual_cents"), F.sum("est_cents").alias("est_cents")))


@query("running_rows")
def running_rows(t: Tables) -> DataFrame:
    """W-5: ROWS running totals; the partition omits the company on purpose, company breaks order ties."""
    m = W.running_sum(_monthly_phase_cost(t), ["job", "cost_type", "phase_group", "phase"], "mth",
                      ["actual_cents", "est_cents"], tie=["jcco"])
    return m.withColumnsRenamed({"actual_cents_running": "actual_running", "est_cents_running": "est_running"})


@query("running_range")
def running_range(t: Tables) -> DataFrame:
    m = _monthly_phase_cost(t)
    return W.running_sum(m, ["job", "cost_type", "phase_group", "phase"], "mth", ["actual_cents", "est_cents"],
                         frame="range")


@query("max_over_all")
def max_over_all(t: Tables) -> DataFrame:
    """W-7: rows carrying the (text-ordered, D12) greatest FC number of the whole budget."""
    b = t.fx.budget.withColumn("fc_number", regex_group("budget_code", r"FC([0-9.]+)"))
    return W.where_max(b, "fc_number")


@query("lead_weeks")
def lead_weeks(t: Tables) -> DataFrame:
    wk = t.fx.weekly.select("proj_id", "week_ending", "resources_to_date")
    return W.rows_back(wk, ["proj_id"], "week_ending", {
        "resources_6_back": ("resources_to_date", 6), "resources_1_back": ("resources_to_date", 1)})


# --- 2.7 set operations, reshape --------------------------------------------------------------------------------
@query("union_all")
def union_all(t: Tables) -> DataFrame:
    con = t.fx.contract.select("jcco", "contract", month_floor("start_date").alias("month"),
                               F.col("orig_contract_cents").alias("amount_cents"), F.lit("original").alias("kind"))
    ci = t.fx.change_item.filter(F.col("approved") == "Y").select(
        "jcco", F.col("project").alias("contract"), month_floor("approved_date").alias("month"),
        F.col("approved_cents").alias("amount_cents"), F.lit("change").alias("kind"))
    return U.stack_rows(con, ci)


@query("union_distinct")
def union_distinct(t: Tables) -> DataFrame:
    jc = t.fx.job_cost.select("jcco", F.trim("job").alias("job"), "actual_cents", "committed_cents", "trans_type")
    a = jc.filter(F.col("actual_cents") != 0).select("jcco", "job")
    c = jc.filter(F.col("committed_cents") != 0).select("jcco", "job")
    e = jc.filter(F.col("trans_type").isin("OE", "CO")).select("jcco", "job")
    return U.stack_rows(a, c, e, distinct=True)


@query("unpivot_metrics")
def unpivot_metrics(t: Tables) -> DataFrame:
    wk = t.fx.weekly
    return U.unpivot(wk, ["proj_id", "week_ending"], [
        ("total_float", "total_float", None),
        ("resources_to_date", "resources_to_date", None),
        ("next_week_resources", "next_week_resources", None),
    ], extra_col=None)


@query("densify_months")
def densify_months(t: Tables) -> DataFrame:
    jc = t.fx.job_cost
    monthly = jc.groupBy("jcco", F.trim("job").alias("contract"), F.col("mth").alias("month")).agg(
        F.sum("actual_cents").alias("actual_cents"))
    con = t.fx.contract.select("jcco", "contract", "start_date")
    spine = U.month_spine(con, F.col("start_date"), date_lit(AS_OF), out="month").select("jcco", "contract", "month")
    return U.densify(spine, monthly, ["jcco", "contract", "month"], ["actual_cents"])


# --- 2.8 scalar functions ---------------------------------------------------------------------------------------
@query("str_trim")
def str_trim(t: Tables) -> DataFrame:
    jc = t.fx.job_cost
    return jc.select(trim_text("job").alias("job"), trim_text("phase").alias("phase"),
                     trim_text("mth").alias("mth_text"), trim_text("cost_type").alias("cost_type")).distinct()


@query("parse_amount")
def parse_amount_q(t: Tables) -> DataFrame:
    s = t.fx.sheet
    return s.select("title", "amount_text",
                    parse_amount("amount_text").cast("bigint").alias("amount"),
                    parse_amount("amount_text", any_hyphen_null=True).cast("bigint").alias("amount_margin_rule"))


@query("strip_html")
def strip_html_q(t: Tables) -> DataFrame:
    p = source(t, "pages")
    return p.select("page_id", strip_html("html").alias("text"))


@query("regex_group")
def regex_group_q(t: Tables) -> DataFrame:
    b = t.fx.budget
    return b.select("budget_code", regex_group("budget_code", r"FC([0-9.]+)").alias("fc_number")).distinct()


@query("split_part")
def split_part_q(t: Tables) -> DataFrame:
    b = t.fx.budget
    return b.select("budget_code", "gl_account",
                    part("budget_code", " ", 1).alias("budget_year_text"),
                    part("gl_account", ".", 2).alias("account_division"),
                    part("gl_account", ".", 5).alias("missing_part")).distinct()


@query("split_index")
def split_index_q(t: Tables) -> DataFrame:
    d = t.fx.dept
    sub = F.replace(F.col("description"), F.lit("Region - "), F.lit(""))
    return d.select("department", "description", word(sub, 0).alias("word0"), word(sub, 1).alias("word1"),
                    word(sub, 2).alias("word2"))


@query("substr_parts")
def substr_parts(t: Tables) -> DataFrame:
    g = t.fx.gl
    return g.select("part2", F.substring("part2", 1, 2).alias("region_number"),
                    F.substring("part2", 3, 4).alias("market_number"),
                    F.left(F.col("part2"), F.lit(2)).alias("left2"), F.right(F.col("part2"), F.lit(3)).alias("right3"),
                    region_code("part2").alias("region_code")).distinct()


@query("concat_null")
def concat_null(t: Tables) -> DataFrame:
    c = t.fx.contract
    return c.select("jcco", "contract",
                    F.concat("jcco", F.lit("-"), "contract").alias("company_contract"),
                    F.concat("contract", F.lit(" "), F.col("owner_contract_date").cast("string")).alias("owner_label"))


@query("cast_text")
def cast_text(t: Tables) -> DataFrame:
    g = t.fx.budget
    return g.select(F.year("mth").cast("string").alias("year_text"),
                    F.concat(F.year("mth").cast("string"), F.lit(" Plan")).alias("plan_name")).distinct()


@query("cast_number")
def cast_number(t: Tables) -> DataFrame:
    o = t.fx.opportunity
    return o.select("version_id", "size_text", as_number("size_text").cast("bigint").alias("size"),
                    as_number(F.concat(F.lit("x"), F.col("size_text"))).cast("bigint").alias("bad_size"))


@query("num_round")
def num_round(t: Tables) -> DataFrame:
    o = source(t, "orders")
    return o.select("o_orderkey", F.round("o_totalprice").alias("price_0"),
                    F.round(F.col("o_totalprice") / 7, 2).alias("price_7th"),
                    F.round(-F.col("o_totalprice") / 3).alias("neg_third"))


@query("num_mod")
def num_mod(t: Tables) -> DataFrame:
    tk = t.fx.task.select("total_float_hr_cnt").distinct()
    days = F.round(F.col("total_float_hr_cnt") / 8).cast("int")
    return tk.select("total_float_hr_cnt", (days % 7).alias("days_mod_7"), (F.floor(days / 7)).alias("weeks"))


@query("fc_versions")
def fc_versions(t: Tables) -> DataFrame:
    b = t.fx.budget.withColumn("fc_number", regex_group("budget_code", r"FC([0-9.]+)"))
    return b.select("budget_code", "fc_number", floor_text("fc_number").alias("fc_floor")).distinct()


@query("div0")
def div0_q(t: Tables) -> DataFrame:
    wk = t.fx.weekly
    nulled = F.when(F.col("total_float") < 0, F.lit(None)).otherwise(F.col("resources_to_date"))
    return wk.select("proj_id", "week_ending",
                     F.round(div0("resources_to_date", "next_week_resources"), 6).alias("ratio"),
                     F.round(div0(nulled, F.col("next_week_resources") * 0), 6).alias("ratio_zero_div"))


@query("null_handling")
def null_handling(t: Tables) -> DataFrame:
    c = t.fx.contract
    return c.select("jcco", "contract",
                    F.coalesce("owner_contract_date", "start_date").alias("start_date"),
                    F.ifnull(F.col("owner_contract_date").cast("string"), F.lit("none")).alias("owner_text"),
                    F.nullif(F.col("orig_contract_cents") % 7, F.lit(0)).alias("mod7_or_null"))


@query("case_rules")
def case_rules_q(t: Tables) -> DataFrame:
    """X-20: nested searched CASE, NULL comparisons fall to ELSE."""
    tk = t.fx.task
    inner = case_rules([(F.col("cstr_type") == "CS_MEO", "hard-end"), (F.col("cstr_type") == "CS_MSO", "hard-start")],
                       "soft")
    kind = case_rules([(F.col("act_end_date").isNotNull(), "done"),
                       (F.col("act_start_date").isNotNull(), "started")], inner)
    return tk.select("proj_id", "task_id", "start_week", kind.alias("kind"))


@query("cast_bool")
def cast_bool(t: Tables) -> DataFrame:
    o = t.fx.opportunity
    return o.select("version_id", "delete_record", as_bool("delete_record").alias("is_deleted"))


@query("parse_datetime")
def parse_datetime(t: Tables) -> DataFrame:
    i = t.fx.incident
    ampm = F.concat(F.col("injury_date_text"), F.lit(" 01:30 PM"))
    return i.select("link", parse_ts("injury_date_text", "MM/dd/yyyy").alias("injury_ts"),
                    parse_ts(ampm, "MM/dd/yyyy hh:mm a").alias("injury_ts_pm"))


@query("first_of_month")
def first_of_month_q(t: Tables) -> DataFrame:
    s = t.fx.sheet
    return s.select("month_text", first_of_month("month_text").alias("month_date")).distinct()


@query("month_floor")
def month_floor_q(t: Tables) -> DataFrame:
    jc = t.fx.job_cost
    return jc.select("actual_date", month_floor("actual_date").alias("month")).distinct()


@query("date_shift")
def date_shift(t: Tables) -> DataFrame:
    c = t.fx.contract
    d = F.col("start_date")
    return c.select("contract", "start_date", shift_date(d, 30, "day").alias("plus_30d"),
                    shift_date(d, -6, "week").alias("minus_6w"), shift_date(d, 1, "month").alias("plus_1m"),
                    shift_date(d, -8, "year").alias("minus_8y"))


@query("date_diff")
def date_diff(t: Tables) -> DataFrame:
    c = t.fx.contract
    return c.select("contract", days_between("start_date", date_lit(AS_OF)).alias("days_open"),
                    month_diff("start_date", date_lit(AS_OF)).alias("months_open"),
                    month_diff("start_date", "owner_contract_date").alias("owner_months"))


@query("date_parts")
def date_parts(t: Tables) -> DataFrame:
    c = t.fx.contract
    return c.select("contract", F.year("start_date").alias("yr"), F.month("start_date").alias("mo"),
                    month_end("start_date").alias("month_end"))


@query("tz_shift")
def tz_shift(t: Tables) -> DataFrame:
    e = source(t, "events")
    return e.select("event_id", shift_zone(F.col("ts"), "UTC", "America/Chicago").alias("ts_central"))
