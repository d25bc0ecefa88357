"""Schedule-quality metrics over weekly task snapshots (R-32..R-43) and the long grading table (R-58).

Grain of every metric: project x snapshot week.  All metrics start from the task snapshots minus 'OFG'-tagged tasks, which
are landed once as a row per task (:func:`histories`).  What needs only a task and its links is counted for
all metrics in one pass over them (:func:`week_stats`, landed too: one row per project and week); the pairs of linked
tasks, the baseline's tasks and the baseline's durations are one join each.

Scale notes: tasks x weeks is the large side.  Link (TASKPRED) statistics are pre-aggregated per task before
they meet the snapshots, and the baseline comparison of ``high_duration`` is pre-aggregated per (baseline project,
task code) instead of fanning out over every baseline snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.functions import case_rules, div0, safe_div
from trestle.operators import aggregates as A
from trestle.operators import joins as J
from trestle.operators import reshape as U
from trestle.operators import windows as W
from trestle.plans.registry import query
from trestle.sources.landing import parts
from trestle.sources.tables import Tables

HARD_CONSTRAINTS = ("CS_MEO", "CS_MSO")
LABOR_COMPANY = "1"
LABOR_COST_TYPE = "1"
LABOR_EXCLUDED_PHASES = ("01", "97", "96", "98")


def open_grading_tasks(t: Tables, tasks: DataFrame | None = None) -> DataFrame:
    """R-32: task snapshots without 'OFG'-tagged tasks (anti join on project, task, week).

    The reference's output carries the tag's ``short_name``, which is always NULL after the filter; it is kept.
    ``tasks``: the snapshots, if they are dealt already.
    """
    return J.drop_tagged(t.fx.task if tasks is None else tasks, _tags(t), ["proj_id", "task_id"], "start_week").withColumn(
        "short_name", F.lit(None).cast("string"))


def _tags(t: Tables) -> DataFrame:
    return t.fx.task_tag.filter(F.col("short_name") == "OFG").select("proj_id", "task_id", "start_week")


def _histories(t: Tables) -> DataFrame:
    """One row per project and task with all its untagged snapshots in ``at``, from one shuffle of the snapshots.

    Snapshots without a task, which no link or tag meets, stand in many rows, so that no row gathers those of a project.
    ``twice``: some week has several snapshots of the task.
    """
    tasks = t.fx.task.repartition(parts(t.fx.task), "proj_id", "task_id")
    rest = [c for c in tasks.columns if c not in ("proj_id", "task_id")]
    apart = F.when(F.col("task_id").isNull(), F.pmod(F.xxhash64(*rest), F.lit(1024))).otherwise(0)
    return (open_grading_tasks(t, tasks).groupBy("proj_id", "task_id", apart.alias("_apart"))
            .agg(F.collect_list(F.struct(*rest)).alias("at")).drop("_apart")
            .withColumn("twice", F.size(F.array_distinct("at.start_week")) < F.size("at")))


def histories(t: Tables) -> DataFrame:
    """The untagged snapshots shared by the nine metrics, a row per task, landed once (see ``trestle.sources.landing``).  A
    metric moves these rows with the columns that it needs (:func:`_at`), a fraction of what single snapshots would take,
    and lists the snapshots behind the shuffle."""
    from trestle.sources.landing import land

    return land(t.spark, t.scope, "task_histories", _histories(t))


def _at(*columns: str) -> Column:
    """The snapshots of a history with these columns only."""
    return F.arrays_zip(*[F.col(f"at.{c}") for c in columns])


def _by_code(rows: DataFrame, *columns: str) -> DataFrame:
    """A history's snapshots (``at``) apart for each task code that they have (one, as a rule), with these columns."""
    codes = F.array_distinct("at.task_code")
    x = rows.select("*", (F.size(codes) == 1).alias("_one"), F.explode(codes).alias("task_code"))
    some = F.filter("at", lambda s: s["task_code"].eqNullSafe(F.col("task_code")))
    return x.withColumn("at", F.when(F.col("_one"), _at(*columns)).otherwise(
        F.transform(some, lambda s: F.struct(*[s[c].alias(c) for c in columns])))).drop("_one")


def _listed(rows: DataFrame, *columns: str) -> DataFrame:
    """A row per snapshot in ``at``, with these columns of it."""
    x = rows.withColumn("_s", F.explode("at"))
    return x.select(*[c for c in rows.columns if c != "at"], *[F.col(f"_s.{c}").alias(c) for c in columns])


def _projects(t: Tables) -> DataFrame:
    return t.fx.project.select("proj_id", "proj_name", "project_name", "baseline_proj_id", "last_recalc_date",
                               "day_hr_cnt", "week_hr_cnt", "completion_date")


def _baselines(t: Tables) -> DataFrame:
    """Baselines with an update date; a project's baseline without one never counts as its first or newest."""
    return t.fx.baseline.filter(F.col("last_baseline_update_date").isNotNull())


def _grade(value: Column, bands) -> Column:
    return case_rules([(pred(value), g) for g, pred in bands], "F")


def _week_stats(t: Tables, tasks: DataFrame | None = None) -> DataFrame:
    links = t.fx.task_pred
    own = links.groupBy("proj_id", "task_id").agg(
        F.countDistinct("task_pred_id").alias("_links"), F.count("pred_task_id").alias("_preds"),
        F.sum(F.when(F.col("pred_type") == "PR_FS", 1).otherwise(0)).alias("_fs"),
        F.sum(F.when(F.col("lag_hr_cnt") > 0, 1).otherwise(0)).alias("_lags"),
        F.sum(F.when(F.col("lag_hr_cnt") < 0, 1).otherwise(0)).alias("_leads"))
    followed = links.select("proj_id", F.col("pred_task_id").alias("task_id")).distinct().withColumn("_followed", F.lit(True))
    # A history meets its task's links, then its project; its snapshots are listed behind that.  The tasks of a week are counted
    # at its first snapshot, an open one if there is any: histories with a week twice are put in order.
    at = ("start_week", "act_end_date", "act_start_date", "target_end_date", "cstr_type", "task_type", "total_float_hr_cnt")
    x = (_histories(t) if tasks is None else tasks).select("proj_id", "task_id", _at(*at).alias("at"), "twice")
    x = x.repartition(parts(t.fx.task), "proj_id", "task_id")
    for known in (own, followed):
        x = x.join(J.hashed(known), ["proj_id", "task_id"], "left")
    sums = {"total_remaining_relationships": "_links", "total_fs_relationships": "_fs", "lags_cnt": "_lags", "leads_cnt": "_leads"}
    x = x.select("proj_id", F.col("task_id").isNotNull().alias("_known"), *[F.coalesce(c, F.lit(0)).alias(c) for c in sums.values()],
                 (F.coalesce("_preds", F.lit(0)) == 0).alias("_no_pred"), F.col("_followed").isNull().alias("_no_succ"),
                 F.when(F.col("twice"), F.sort_array("at")).otherwise(F.col("at")).alias("at"), "twice")
    # Baseline projects are no rows of the project table; their weeks count too.  A project's rows each count its snapshots.
    projects = _projects(t).groupBy("proj_id").agg(F.collect_list(F.struct("last_recalc_date", "day_hr_cnt")).alias("_projects"))
    x = x.join(J.hashed(projects), "proj_id", "left")
    first = F.transform("at", lambda s, i: (i == 0) | ~F.get("at", i - 1)["start_week"].eqNullSafe(s["start_week"]))
    x = x.withColumn("_first", F.when(F.col("twice"), first))
    x = x.select("*", F.posexplode_outer("_projects").alias("_row", "_p")).drop("_projects")
    x = x.select("*", F.posexplode("at").alias("_i", "_s"))
    x = x.select(*[c for c in x.columns if c not in ("at", "_first", "_s")], *[F.col(f"_s.{c}").alias(c) for c in at],
                 (F.col("_known") & (F.coalesce("_row", F.lit(0)) == 0) & F.coalesce(F.get("_first", "_i"), F.lit(True))).alias("_once"))
    is_open, c, tt = F.col("act_end_date").isNull(), F.col("cstr_type"), F.col("task_type")
    no_pred, no_succ = F.col("_no_pred"), F.col("_no_succ")
    missing = ((tt.isin("TT_Task", "TT_LOE") & (no_pred | no_succ)) | ((tt == "TT_Mile") & no_succ)
               | ((tt == "TT_FinMile") & no_pred))
    counts = {
        "total_tasks_cnt": F.col("_once"), "total_tasks_remaining": F.col("_once") & is_open,
        "open_rows": is_open, "actual_complete": ~is_open, "due": F.col("target_end_date") <= F.col("start_week"),
        "num_hard_consts": is_open & c.isin(*HARD_CONSTRAINTS),
        "num_soft_consts": is_open & c.isNotNull() & ~c.isin(*HARD_CONSTRAINTS),
        "num_invalid_dates": is_open & (F.col("act_start_date") > F.col("_p.last_recalc_date")),
        "high_float": is_open & (F.col("total_float_hr_cnt") / F.col("_p.day_hr_cnt") > 44),
        "total_missing_logic_cnt": is_open & missing,
    }
    # The key is no plain column, so that each task adds up its projects' weeks before they move, a hot project's parts apart.
    return x.groupBy(F.struct("proj_id").alias("_project"), "start_week").agg(
        *[F.sum(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in counts.items()],
        *[F.sum(F.when(is_open, F.col(col)).otherwise(0)).alias(name) for name, col in sums.items()]).select(
        "_project.proj_id", "start_week", *counts, *sums)


def week_stats(t: Tables) -> DataFrame:
    """Per project and snapshot week everything that needs only a task and its own links, from one pass over the histories
    (one join of the tasks with their links' counts); landed once and shared by the metrics."""
    from trestle.sources.landing import land

    return land(t.spark, t.scope, "schedule_week_stats", _week_stats(t, histories(t)))


def _open_weeks(t: Tables) -> DataFrame:
    """Project attributes and counts of the weeks in which a project has open tasks, landed for the metrics that share them."""
    from trestle.sources.landing import land

    return land(t.spark, t.scope, "schedule_open_weeks",
                week_stats(t).filter(F.col("open_rows") > 0).join(_projects(t), "proj_id"))


@query("sched_constraints")
def constraints(t: Tables) -> DataFrame:
    """R-35: hard constraints (A if <= 1), soft-constraint share, actual starts after the data date."""
    g = _open_weeks(t)
    g = g.withColumn("pct_soft_consts", div0("num_soft_consts", "total_tasks_remaining") * 100)
    n_inv = F.col("num_invalid_dates")
    return g.filter(F.col("start_week").isNotNull()).select(
        "proj_id", "proj_name", "start_week", "num_hard_consts",
        F.when(F.col("num_hard_consts") <= 1, "A").otherwise("F").alias("hard_consts_grade"),
        "num_soft_consts", F.round("pct_soft_consts", 6).alias("pct_soft_consts"),
        _grade(F.col("pct_soft_consts"), [("A", lambda v: v < 4), ("B", lambda v: v < 5), ("C", lambda v: v < 6),
                                          ("D", lambda v: v < 7)]).alias("soft_consts_grade"),
        "num_invalid_dates",
        # the third band is a lower-case 'c' in the reference (it later earns no points); kept
        case_rules([(n_inv == 0, "A"), (n_inv <= 2, "B"), (n_inv <= 3, "c"), (n_inv <= 5, "D")], "F")
        .alias("invalid_date_grade"))


@query("sched_relationships")
def relationships(t: Tables) -> DataFrame:
    """R-41: finish-to-start share of the open tasks' links."""
    r = _open_weeks(t)
    r = r.withColumn("fs_pct", div0("total_fs_relationships", "total_remaining_relationships") * 100)
    return r.filter(F.col("start_week").isNotNull()).select(
        "proj_id", "proj_name", "start_week", "total_remaining_relationships", "total_fs_relationships",
        F.round("fs_pct", 6).alias("fs_pct"),
        _grade(F.col("fs_pct"), [("A", lambda v: v >= 95), ("B", lambda v: v >= 90), ("C", lambda v: v >= 85),
                                 ("D", lambda v: v >= 80)]).alias("fs_grade"))


@query("sched_lag_lead")
def lag_lead(t: Tables) -> DataFrame:
    """R-38: lag and lead shares; the denominator counts distinct links, the numerators count rows."""
    r = _open_weeks(t)
    r = r.withColumns({"lags_pct": div0("lags_cnt", "total_remaining_relationships") * 100,
                       "leads_pct": div0("leads_cnt", "total_remaining_relationships") * 100})
    lp = F.col("leads_pct")
    return r.filter(F.col("start_week").isNotNull()).select(
        "proj_id", "proj_name", "start_week", "total_remaining_relationships", "lags_cnt",
        F.round("lags_pct", 6).alias("lags_pct"),
        _grade(F.col("lags_pct"), [("A", lambda v: v <= 2), ("B", lambda v: v <= 4), ("C", lambda v: v <= 6),
                                   ("D", lambda v: v <= 8)]).alias("lags_grade"),
        "leads_cnt", F.round("leads_pct", 6).alias("leads_pct"),
        case_rules([(lp == 0, "A"), (lp <= 1, "D")], "F").alias("leads_grade"))


@query("sched_missing_logic")
def missing_logic(t: Tables) -> DataFrame:
    """R-39: open tasks without predecessor or successor, start milestones without successor, finish
    milestones without predecessor."""
    g = _open_weeks(t).withColumn("total_tasks_cnt", F.col("total_tasks_remaining"))
    n = F.col("total_missing_logic_cnt")
    return g.filter(F.col("start_week").isNotNull()).select(
        "proj_id", "proj_name", "start_week", "total_tasks_cnt", "total_missing_logic_cnt",
        F.round(div0(n, "total_tasks_cnt") * 100, 6).alias("missing_logic_pct"),
        case_rules([(n <= 4, "A"), (n <= 7, "B"), (n <= 10, "C"), (n <= 15, "D")], "F").alias("missing_logic_grade"))


# A link is out of sequence when the successor progressed before its predecessor allowed it.
#   link type -> (predecessor date that must exist, successor date that shows progress)
OUT_OF_SEQUENCE_RULES = (
    ("PR_FS", "pred_act_end_date", "act_start_date"),
    ("PR_SS", "pred_act_start_date", "act_start_date"),
    ("PR_SF", "pred_act_start_date", "act_end_date"),
    ("PR_FF", "pred_act_end_date", "act_end_date"),
)


def _out_of_sequence(t: Tables) -> DataFrame:
    """Per project and week the predecessors of open tasks and the links out of sequence.

    Successors' weeks, one row per link, and predecessors' weeks are dealt by predecessor together.  All pairs of a link's
    and a predecessor's snapshot of a week count, so their number is the product of the links that ask for a date and the
    snapshots without it.
    """
    links = t.fx.task_pred.select("proj_id", "task_id", "pred_task_id", "pred_type")
    snapshots = histories(t).select("proj_id", "task_id", _at("start_week", "act_start_date", "act_end_date").alias("at"))
    succ = snapshots.withColumn("at", F.filter("at", lambda s: s["act_end_date"].isNull())).filter(F.size("at") > 0)
    pred = snapshots.withColumnRenamed("task_id", "pred_task_id")
    asked = succ.repartition(parts(t.fx.task), "proj_id", "task_id").join(J.hashed(links), ["proj_id", "task_id"]).select(
        "proj_id", "pred_task_id", "pred_type", "at", F.lit(True).alias("_asks"))
    both = asked.unionByName(pred.withColumns({"pred_type": F.lit(None).cast("string"), "_asks": F.lit(False)}))
    both = both.filter("proj_id IS NOT NULL AND pred_task_id IS NOT NULL").repartition(
        parts(t.fx.task), "proj_id", "pred_task_id")
    x = _listed(both, "start_week", "act_start_date", "act_end_date").filter(F.col("start_week").isNotNull())
    without = {"pred_act_start_date": F.col("act_start_date").isNull(), "pred_act_end_date": F.col("act_end_date").isNull()}
    need = case_rules([((F.col("pred_type") == typ) & F.col(prog).isNotNull(), need)
                       for typ, need, prog in OUT_OF_SEQUENCE_RULES], None)
    x = x.groupBy("proj_id", "pred_task_id", "start_week").agg(
        F.count(F.when(F.col("_asks"), 1)).alias("_links"), F.count(F.when(~F.col("_asks"), 1)).alias("_snapshots"),
        *[F.count(F.when(F.col("_asks") & (need == c), 1)).alias(f"_need_{c}") for c in without],
        *[F.count(F.when(~F.col("_asks") & cond, 1)).alias(f"_no_{c}") for c, cond in without.items()])
    out = sum((F.col(f"_need_{c}") * F.col(f"_no_{c}") for c in without), F.lit(0))
    return x.filter((F.col("_links") > 0) & (F.col("_snapshots") > 0)).groupBy("proj_id", "start_week").agg(
        F.count("pred_task_id").alias("total_task_cnt"), F.sum(out).alias("out_seq_cnt"))


@query("sched_out_of_sequence")
def out_of_sequence(t: Tables) -> DataFrame:
    """R-40: open tasks progressed before their predecessor, as a share of the distinct predecessors.

    Predecessors are looked up in the same (untagged) snapshot and week; links whose predecessor is tagged
    or missing are not seen.  A zero denominator gives NULL (D4).
    """
    from trestle.sources.landing import land

    g = land(t.spark, t.scope, "schedule_out_of_sequence", _out_of_sequence(t))
    g = g.join(_projects(t).select("proj_id", "proj_name"), "proj_id")
    pct = safe_div(F.col("out_seq_cnt"), F.col("total_task_cnt")) * 100
    g = g.withColumn("out_seq_pct", pct)
    return g.filter(F.col("start_week").isNotNull()).select(
        "proj_id", "proj_name", "start_week", "total_task_cnt", "out_seq_cnt", F.round("out_seq_pct", 6).alias("out_seq_pct"),
        _grade(F.col("out_seq_pct"), [("A", lambda v: v < 1), ("B", lambda v: v < 9), ("C", lambda v: v < 15),
                                      ("D", lambda v: v < 20)]).alias("out_seq_grade"))


def _wbs_name(wbs_id: Column) -> Column:
    """PROJWBS analog: work breakdown 1 holds the milestones."""
    return F.when(wbs_id == 1, "Milestones").otherwise("Work")


@query("sched_float")
def float_metrics(t: Tables) -> DataFrame:
    """R-36: high-float share, total float days, TFCI and CPLI.

    The critical path comes from the newest snapshot week only (earliest open finish milestone, W-1) and is
    applied to every week of the project.  Weeks are ROUNDed, not floored, plus the remainder (kept).
    """
    floats = _open_weeks(t)
    # Projects without any snapshot follow with an empty week.
    without = _projects(t).join(week_stats(t).select("proj_id").distinct(), "proj_id", "left_anti")
    floats = floats.unionByName(without.withColumns({"total_tasks_remaining": F.lit(0).cast("long"), "high_float": F.lit(0).cast(
        "long")}), allowMissingColumns=True).select("proj_id", "proj_name", "day_hr_cnt", "week_hr_cnt", "start_week",
                                                    "completion_date", "total_tasks_remaining", "high_float")
    weekly = t.fx.weekly.select("proj_id", F.col("week_ending").alias("start_week"), "total_float")
    ff = floats.join(weekly, ["proj_id", "start_week"], "left")
    tasks = _listed(histories(t).select("proj_id", "task_id", _at(
        "start_week", "early_end_date", "task_type", "wbs_id", "act_end_date").alias("at")),
        "start_week", "early_end_date", "task_type", "wbs_id", "act_end_date")
    newest = t.fx.task.select(F.max("start_week")).scalar()
    cand = (ff.select("proj_id", "start_week")
            .join(tasks.select("proj_id", "start_week", "task_id", "early_end_date", "task_type", "wbs_id",
                               "act_end_date"), ["proj_id", "start_week"], "inner")
            .filter((_wbs_name(F.col("wbs_id")) == "Milestones") & (F.col("task_type") == "TT_FinMile")
                    & (F.col("start_week") == newest) & F.col("act_end_date").isNull()))
    crit = W.earliest_per_key(cand, ["proj_id"], ["early_end_date"], tie=["task_id"]).select(
        "proj_id", F.col("start_week").alias("critical_path_start"), F.col("early_end_date").alias("critical_path_end"))
    x = ff.join(crit, "proj_id", "left")
    d_finish = F.datediff("completion_date", "start_week")
    d_crit = F.datediff("critical_path_end", "critical_path_start")
    dpw = F.col("week_hr_cnt") / F.col("day_hr_cnt")
    x = x.withColumns({
        "remaining_working_days": F.round(d_finish / 7, 0) * dpw + d_finish % 7,
        "critical_path_duration": F.round(d_crit / 7, 0) * dpw + d_crit % 7,
    })
    x = x.withColumns({
        "tfci": div0(F.col("remaining_working_days") + F.col("total_float"), F.col("remaining_working_days")),
        "cpli": div0(F.col("critical_path_duration") + F.col("total_float"), F.col("critical_path_duration")),
        "pct_high_float": safe_div(F.col("high_float"), F.col("total_tasks_remaining")) * 100,
        "total_float_days": F.col("total_float") * 8 / F.col("day_hr_cnt"),
    })
    tfd = F.col("total_float_days")
    return x.select(
        "proj_id", "proj_name", "start_week", "high_float", F.round("pct_high_float", 6).alias("pct_high_float"),
        _grade(F.col("pct_high_float"), [("A", lambda v: v < 3), ("B", lambda v: v < 5), ("C", lambda v: v < 10),
                                         ("D", lambda v: v < 15)]).alias("high_float_grade"),
        F.round(tfd, 6).alias("total_float_days"),
        case_rules([(tfd > 15, "A"), (tfd.between(0, 15), "B"), (tfd.between(-10, -1), "C"),
                    (tfd.between(-20, -11), "D")], "F").alias("negative_float_grade"),
        F.round("tfci", 6).alias("tfci"),
        _grade(F.col("tfci"), [("A", lambda v: v >= 1), ("B", lambda v: v >= 0.97), ("C", lambda v: v >= 0.95),
                               ("D", lambda v: v >= 0.9)]).alias("tfci_grade"),
        F.round("cpli", 6).alias("cpli"),
        _grade(F.col("cpli"), [("A", lambda v: v >= 1), ("B", lambda v: v >= 0.95), ("C", lambda v: v >= 0.9),
                               ("D", lambda v: v >= 0.85)]).alias("cpli_grade"))


def _high_duration(t: Tables) -> DataFrame:
    """Per project, baseline and week the open tasks times their baseline snapshots, all and long ones.

    Written with the tasks as the streamed side: one project can hold a large share of them, and Spark splits a hot
    key of the left side only.  Projects without any snapshot follow with empty task columns.
    """
    latest = W.top_rank(_baselines(t), ["orig_proj_id"], ["last_baseline_update_date", "baseline_proj_id"])
    projects = _projects(t).select("proj_id", "proj_name", "day_hr_cnt")
    open_at = F.filter(_at("start_week", "task_code", "act_end_date"), lambda s: s["act_end_date"].isNull())
    tasks = _by_code(histories(t).select("proj_id", open_at.alias("at")), "start_week")
    found = tasks.join(J.hashed(projects), "proj_id")
    seen = A.dealt(histories(t).select("proj_id"), ["proj_id"]).distinct()
    week, code = (F.lit(None).cast(t.fx.task.schema[c].dataType).alias(c) for c in ("start_week", "task_code"))
    tp = found.unionByName(projects.join(seen, "proj_id", "left_anti").withColumns({"at": F.array(F.struct(week)), "task_code": code}))
    tp = tp.join(latest.select(F.col("orig_proj_id").alias("proj_id"), F.col("baseline_proj_id").alias("bl_id")),
                 "proj_id", "left")
    durations = _listed(histories(t).select(F.col("proj_id").alias("bl_id"), _at("task_code", "target_drtn_hr_cnt").alias("at")),
                        "task_code", "target_drtn_hr_cnt")
    base = durations.groupBy("bl_id", "task_code", "target_drtn_hr_cnt").agg(F.count(F.lit(1)).alias("_n"))
    x = tp.join(base, ["bl_id", "task_code"], "left")
    rows = F.coalesce(F.col("_n"), F.lit(1))
    long_ = F.when(F.col("target_drtn_hr_cnt") / F.col("day_hr_cnt") > 20, rows).otherwise(0)
    x = _listed(x.withColumns({"_rows": rows, "_long": long_}), "start_week")
    return x.groupBy("proj_id", "proj_name", F.col("bl_id").alias("baseline_proj_id"), "start_week").agg(
        F.sum("_rows").alias("remaining_tasks_cnt"), F.sum("_long").alias("long_duration_cnt"))


@query("sched_high_duration")
def high_duration(t: Tables) -> DataFrame:
    """R-37: share of open tasks whose baseline duration exceeds 20 days.

    The latest baseline per project is picked by RANK (W-3).  Baseline tasks are matched by task code only,
    not by week, so every open task counts once per baseline snapshot (kept); that fan-out is computed from a
    per-(baseline, task code, duration) count instead of being materialised.  Rows with a NULL week are kept.
    """
    from trestle.sources.landing import land

    g = land(t.spark, t.scope, "schedule_high_duration", _high_duration(t))
    g = g.withColumn("long_dur_pct", safe_div(F.col("long_duration_cnt"), F.col("remaining_tasks_cnt")) * 100)
    return g.select("proj_id", "proj_name", "start_week", "baseline_proj_id", "remaining_tasks_cnt", "long_duration_cnt",
                    F.round("long_dur_pct", 6).alias("long_dur_pct"),
                    _grade(F.col("long_dur_pct"), [("A", lambda v: v <= 1), ("B", lambda v: v <= 2),
                                                   ("C", lambda v: v <= 3), ("D", lambda v: v <= 4)]).alias("dur_grade"))


def _missed(t: Tables, baselines: DataFrame) -> DataFrame:
    """Per project and week how often a task ended after, or is open past, the end that a baseline's snapshot of that week has
    for its code; weeks without any are left out.  Histories are dealt by baseline and code, and listed there to meet by week:
    the join asks for no other shuffle if ``spark.sql.requireAllClusterKeysForCoPartition`` is off."""
    deal = [parts(t.fx.task), "baseline_proj_id", "task_code"]
    cur = _by_code(histories(t).select("proj_id", _at("start_week", "task_code", "act_end_date").alias("at")), "start_week", "act_end_date")
    cur = cur.join(J.hashed(baselines), "proj_id").repartition(*deal)
    bl = histories(t).select(F.col("proj_id").alias("baseline_proj_id"), _at("start_week", "task_code", "early_end_date").alias("at"))
    bl = _by_code(bl, "start_week", "early_end_date").repartition(*deal)
    x = _listed(cur, "start_week", "act_end_date").join(
        J.hashed(_listed(bl, "start_week", "early_end_date")), ["baseline_proj_id", "task_code", "start_week"])
    late = ((F.col("act_end_date") > F.col("early_end_date"))
            | (F.col("act_end_date").isNull() & (F.col("early_end_date") <= F.col("start_week"))))
    return x.filter(late).groupBy("proj_id", "start_week").agg(F.count(F.lit(1)).alias("num_missed_tasks"))


@query("sched_baseline")
def baseline_metrics(t: Tables) -> DataFrame:
    """R-43: baseline execution index and missed activities against the *earliest* dated baseline.

    Counts of one project's week, current or baseline, come from the shared pass (:func:`week_stats`).
    """
    from trestle.sources.landing import land, settings

    proj = _projects(t)
    earliest = W.earliest_per_key(_baselines(t), ["orig_proj_id"], ["last_baseline_update_date", "baseline_proj_id"])
    pb = proj.select("proj_id", "proj_name").join(
        earliest.select(F.col("orig_proj_id").alias("proj_id"), "baseline_proj_id"), "proj_id", "left")
    weeks = week_stats(t)
    actual = weeks.select("proj_id", "start_week", "total_tasks_cnt", "actual_complete")
    bcomplete = weeks.select(F.col("proj_id").alias("baseline_proj_id"), "start_week", F.col("due").alias("baseline_complete"))
    both = pb.join(actual, "proj_id").join(bcomplete, ["baseline_proj_id", "start_week"], "left")
    with settings(t.spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        missed = land(t.spark, t.scope, "schedule_missed_tasks", _missed(t, pb.select("proj_id", "baseline_proj_id")))
    x = both.join(missed, ["proj_id", "start_week"], "left").fillna(0, ["num_missed_tasks"]).filter(
        F.col("start_week").isNotNull())
    x = x.withColumns({"bei": safe_div(F.col("actual_complete"), F.col("baseline_complete")),
                       "missed_pct": (1 - safe_div(F.col("num_missed_tasks"), F.col("baseline_complete"))) * 100})
    return x.select(
        "proj_id", "proj_name", "baseline_proj_id", "start_week", "total_tasks_cnt", "actual_complete", "baseline_complete",
        F.round("bei", 6).alias("bei"),
        _grade(F.col("bei"), [("A", lambda v: v >= 1), ("B", lambda v: v >= 0.95), ("C", lambda v: v >= 0.9),
                              ("D", lambda v: v >= 0.85)]).alias("bei_grade"),
        "num_missed_tasks", F.round("missed_pct", 6).alias("missed_pct"),
        _grade(F.col("missed_pct"), [("A", lambda v: v >= 100), ("B", lambda v: v >= 95), ("C", lambda v: v >= 90),
                                     ("D", lambda v: v >= 85)]).alias("miss_act_grade"))


def _task_weeks(t: Tables) -> DataFrame:
    """The projects and weeks of the untagged snapshots, for who needs no counts of them (landed once)."""
    from trestle.sources.landing import land

    key = ["proj_id", "start_week"]
    return land(t.spark, t.scope, "schedule_task_weeks", A.dealt(open_grading_tasks(t).select(*key), key).distinct())


@query("sched_resource_look_ahead")
def resource_look_ahead(t: Tables, weeks: DataFrame | None = None) -> DataFrame:
    """R-42: field labour cost of the last 6 weeks and last week, resources earned over 6 snapshots (LEAD over
    descending weeks), CPI and the look-ahead ratio.

    Both trailing windows of the labour cost come from one event sweep (J-9).  The job key is the text before
    the first '.' of the (trimmed) job.  The reference picks an arbitrary row per project-week; rows are
    unique per project-week here.  ``weeks``: projects and weeks, if they are at hand.
    """
    proj = _projects(t).select(F.col("proj_id").alias("p6_proj_id"), F.col("project_name").alias("job_key"),
                               "proj_name")
    weeks = _task_weeks(t) if weeks is None else weeks
    weeks = weeks.select(F.col("proj_id").alias("p6_proj_id"), "start_week")
    psw = proj.join(weeks, "p6_proj_id", "left")
    jc = t.fx.job_cost
    labor = (jc.filter((F.col("jcco") == LABOR_COMPANY) & (F.col("cost_type") == LABOR_COST_TYPE)
                       & ~F.left(F.col("phase"), F.lit(2)).isin(*LABOR_EXCLUDED_PHASES))
             .groupBy(F.split_part(F.trim("job"), F.lit("."), F.lit(1)).alias("job_key"), "actual_date")
             .agg(F.sum("actual_cents").alias("_cost")))
    fl = J.trailing_sums(psw, labor, ["job_key"], "start_week", "actual_date", "_cost", {
        "total_labor_cost": 42, "current_labor_cost": 7}).fillna(0, ["total_labor_cost", "current_labor_cost"])
    sub = t.fx.weekly.select(F.col("proj_id").alias("p6_proj_id"), F.col("week_ending").alias("start_week"),
                             "resources_to_date", "next_week_resources")
    # Weeks without a subtotal neither count as steps back nor give a row.
    used = psw.select("p6_proj_id", "start_week").join(sub, ["p6_proj_id", "start_week"])
    used = W.rows_back(used, ["p6_proj_id"], "start_week", {"resource_6wa": ("resources_to_date", 6)}).select(
        "p6_proj_id", "start_week", (F.col("resources_to_date") - F.col("resource_6wa")).alias("resources_used_6_weeks"),
        "next_week_resources")
    x = fl.join(used, ["p6_proj_id", "start_week"])
    x = x.withColumn("six_week_cpi", div0("resources_used_6_weeks", "total_labor_cost"))
    x = x.withColumn("resource_look_ahead_pct",
                     div0(F.col("current_labor_cost") * F.col("six_week_cpi"), F.col("next_week_resources")) * 100)
    p = F.col("resource_look_ahead_pct")
    grade = case_rules([
        (p.between(90, 120), "A"),
        (p.between(85, 90) | p.between(120, 130), "B"),
        (p.between(80, 85) | p.between(130, 140), "C"),
        (p.between(75, 80) | p.between(140, 150), "D"),
    ], "F")
    return x.select(
        F.col("p6_proj_id").alias("proj_id"), "proj_name", "start_week", F.round("six_week_cpi", 6).alias("six_week_cpi"),
        "current_labor_cost", "next_week_resources", F.round(p, 6).alias("resource_look_ahead_pct"),
        grade.alias("resource_look_ahead_grade"))


# The 16 graded metrics -> (value column, grade column, order, type, display name).
METRICS = (
    ("hard_constraints", "num_hard_consts", "hard_consts_grade", 7, "architecture", "Hard Constraints (#)"),
    ("soft_constraints", "pct_soft_consts", "soft_consts_grade", 8, "architecture", "Soft Constraints (%)"),
    ("invalid_dates", "num_invalid_dates", "invalid_date_grade", 9, "architecture", "Invalid Dates (#)"),
    ("high_float", "pct_high_float", "high_float_grade", 2, "architecture", "High Float (%)"),
    ("total_float_days", "total_float_days", "negative_float_grade", 14, "performance", "Total Float Days (#)"),
    ("tfci", "tfci", "tfci_grade", 13, "performance", "Total Float Consumption Index (TFCI)"),
    ("cpli", "cpli", "cpli_grade", 12, "performance", "Critical Path Length Index (CPLI)"),
    ("missing_logic", "total_missing_logic_cnt", "missing_logic_grade", 3, "architecture", "Missing Logic (#)"),
    ("fs_relationships", "fs_pct", "fs_grade", 4, "architecture", "FS Relationship (%)"),
    ("lags", "lags_pct", "lags_grade", 5, "architecture", "Lags (%)"),
    ("leads", "leads_pct", "leads_grade", 6, "architecture", "Leads (%)"),
    ("out_of_sequence", "out_seq_pct", "out_seq_grade", 10, "architecture", "Out of Sequence Activities (%)"),
    ("resource_look_ahead", "resource_look_ahead_pct", "resource_look_ahead_grade", 15, "performance",
     "Resource Lookahead (%)"),
    ("bei", "bei", "bei_grade", 11, "performance", "Baseline Execution Index (BEI)"),
    ("missed_activities", "missed_pct", "miss_act_grade", 16, "performance", "Missed Activities (%)"),
    ("long_duration", "long_dur_pct", "dur_grade", 1, "architecture", "Long Duration (%)"),
)
# Grade points, and the metrics weighted by a quarter ('clpi' is misspelt in the reference, so
# cpli keeps full weight).
GRADE_POINTS = (("A", 4), ("B", 3), ("C", 2), ("D", 1), ("F", 0))
QUARTER_WEIGHT = ("bei", "clpi", "tfci", "total_float_days")


def grading_wide(t: Tables) -> DataFrame:
    """The nine metric tables joined on (proj_id, start_week), based on the constraints metric."""
    key = ["proj_id", "start_week"]
    a = constraints(t)
    parts = [
        float_metrics(t).select(*key, "pct_high_float", "high_float_grade", "total_float_days", "negative_float_grade",
                                "tfci", "tfci_grade", "cpli", "cpli_grade"),
        missing_logic(t).select(*key, "total_missing_logic_cnt", "missing_logic_grade"),
        relationships(t).select(*key, "fs_pct", "fs_grade"),
        lag_lead(t).select(*key, "lags_pct", "lags_grade", "leads_pct", "leads_grade"),
        out_of_sequence(t).select(*key, "out_seq_pct", "out_seq_grade"),
        resource_look_ahead(t, week_stats(t)).select(*key, "resource_look_ahead_pct", "resource_look_ahead_grade"),
        baseline_metrics(t).select(*key, "bei", "bei_grade", "missed_pct", "miss_act_grade"),
        high_duration(t).select(*key, "long_dur_pct", "dur_grade"),
    ]
    out = a.select(*key, "proj_name", "num_hard_consts", "hard_consts_grade", "pct_soft_consts", "soft_consts_grade",
                   "num_invalid_dates", "invalid_date_grade")
    for p in parts:
        out = out.join(p, key, "left")
    return out


@query("grading_long")
def grading_long(t: Tables, wide: DataFrame | None = None) -> DataFrame:
    """R-58: 16 metrics per project-week in long form with order, type, label, points and weight.

    Unpivoted in one pass (explode of 16 structs) instead of a 16-way UNION ALL over the 9-join plan.
    Projects without open tasks are absent (the base is the constraints metric); a metric row missing after
    the left join gives a NULL grade and NULL points.  ``wide``: the joined metrics, if they are at hand.
    """
    wide = (grading_wide(t) if wide is None else wide).withColumn("proj_id", F.col("proj_id").cast("string"))
    long_ = U.unpivot(wide, ["proj_id", "proj_name", "start_week"], [(m[0], m[1], m[2]) for m in METRICS],
                      name_col="metric_name", value_col="metric_value", extra_col="metric_grade")
    name = F.col("metric_name")
    points = case_rules([(F.col("metric_grade") == g, p) for g, p in GRADE_POINTS], None)
    long_ = long_.withColumns({
        "metric_value": F.round("metric_value", 6),
        "metric_order": case_rules([(name == m[0], m[3]) for m in METRICS], None),
        "metric_type": case_rules([(name == m[0], m[4]) for m in METRICS], None),
        "metric_full_name": case_rules([(name == m[0], m[5]) for m in METRICS], None),
        "grade_points": points,
    })
    return long_.withColumn("adj_grade_points", F.when(name.isin(*QUARTER_WEIGHT), F.col("grade_points") * 0.25)
                            .otherwise(F.col("grade_points").cast("double")))
