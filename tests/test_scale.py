"""Steps over the long tables neither sort nor gather whole map-side tables: what would spill or grow with a task's rows."""

import pytest

from trestle.plans import schedule
from trestle.plans.registry import load_all
from trestle.sources.tables import Tables

from conftest import SF_SMALL, rows


@pytest.fixture
def lazy(spark, monkeypatch):
    monkeypatch.setenv("TRESTLE_LAND", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield Tables(spark, SF_SMALL)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("build", [schedule._week_stats, schedule.open_grading_tasks])
def test_task_snapshots_are_not_sorted(lazy, build):
    text = plan(build(lazy))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" in text


def test_tags_count_by_week_and_empty_keys_stay(spark):
    class T:
        pass
    t = T()
    t.spark, t.scope, t.fx = spark, "test-week-tags", T()
    t.fx.task = spark.sql("""select * from values (1L, 11L, date'2024-01-01'), (1L, 11L, date'2024-01-08'),
        (1L, 11L, cast(null as date)), (1L, cast(null as bigint), date'2024-01-01'), (1L, 12L, date'2024-01-01'),
        (1L, 12L, date'2024-01-01') as x(proj_id, task_id, start_week)""").selectExpr(
        "*", "'TT_Task' task_type", "cast(null as date) act_start_date", "cast(null as date) act_end_date",
        "date'2024-01-01' target_end_date", "cast(null as string) cstr_type", "0L total_float_hr_cnt")
    t.fx.task_tag = spark.sql("""select * from values (1L, 11L, date'2024-01-08', 'OFG'), (1L, 11L, cast(null as date), 'OFG'),
        (1L, 12L, date'2024-01-01', 'other') as x(proj_id, task_id, start_week, short_name)""")
    t.fx.task_pred = spark.sql("select 1L proj_id, 11L task_id, 12L pred_task_id, 1L task_pred_id, 'PR_FS' pred_type, 2 lag_hr_cnt")
    t.fx.project = spark.sql("""select 1L proj_id, 'P' proj_name, '1' project_name, 2L baseline_proj_id, date'2024-01-01'
        last_recalc_date, 8 day_hr_cnt, 40 week_hr_cnt, date'2024-06-30' completion_date""")
    got = {r.start_week and str(r.start_week): r for r in schedule._week_stats(t).collect()}
    assert {k: (r.total_tasks_cnt, r.open_rows, r.lags_cnt) for k, r in got.items()} == {
        "2024-01-01": (2, 4, 1), None: (1, 1, 1)}


@pytest.mark.parametrize("build", [load_all()["cond_sum"], lambda t: t.fx.weekly])
def test_groups_of_few_rows_are_not_gathered_map_side(lazy, build):
    """The task that makes the rows of a snapshot file keeps no table of their groups: rows are dealt first."""
    text = build(lazy)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in text.split("== Initial Plan ==")[-1].splitlines()]
    groups = [i for i, x in enumerate(lines) if "HashAggregate" in x and "proj_id" in x]
    deal = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert len(groups) == 2 and len(deal) == 1 and max(groups) < deal[0]


def test_the_wide_form_is_made_by_need(spark, monkeypatch):
    from trestle.sources import landing

    landed = []
    land = landing.land
    monkeypatch.setattr(landing, "land", lambda s, scope, name, *a: landed.append(name) or land(s, scope, name, *a))
    t = Tables(spark, SF_SMALL)
    assert rows(t.fx.crm_opportunity.groupBy().count()) == rows(t.fx.opportunity.groupBy().count())
    assert landed == ["analog-opportunity"]


@pytest.mark.parametrize("key", ["sched_resource_look_ahead", "sched_high_duration"])
def test_no_counts_are_made_for_who_needs_only_projects_and_weeks(spark, monkeypatch, key):
    monkeypatch.setattr(schedule, "week_stats", lambda t: pytest.fail("counts all links and tasks"))
    assert load_all()[key](Tables(spark, SF_SMALL)).count() > 0


@pytest.fixture
def odd_schedule(spark):
    """Few projects, tasks and weeks, many repeats and nulls."""
    import random

    r = random.Random(5)

    def pick(*values):
        return r.choice((*values, None)) if r.random() < 0.4 else r.choice(values)

    weeks = ["2024-01-01", "2024-01-08", "2024-01-15"]
    days = ["2023-12-20", "2024-01-03", "2024-01-10", "2024-02-01"]
    tasks = [(pick(1, 2, 3, 11, 12), pick(*range(6)), pick(*weeks), pick("A", "B", "C"), pick("TT_Task", "TT_LOE", "TT_Mile", "TT_FinMile"),
              r.choice((1, 2)), r.choice((None, *days)), r.choice((None, None, *days)), pick(*days), pick(*days), pick("CS_MEO", "CS_MSO", "CS_X"),
              pick(10, 400, 500), pick(80, 200, 400)) for _ in range(260)]
    t = Tables(spark, SF_SMALL)
    made = spark.createDataFrame(tasks, """proj_id long, task_id long, start_week string, task_code string, task_type string,
        wbs_id int, act_start_date string, act_end_date string, target_end_date string, early_end_date string, cstr_type string,
        total_float_hr_cnt long, target_drtn_hr_cnt long""")
    dates = [c for c in made.columns if "date" in c or c == "start_week"]
    t.fx.task = made.withColumns({c: made[c].cast("date") for c in dates})
    t.fx.task_tag = spark.sql("select * from values (1L, 2L, date'2024-01-08', 'OFG'), (2L, 3L, null, 'OFG'), "
                              "(11L, 1L, date'2024-01-01', 'OFG') as x(proj_id, task_id, start_week, short_name)")
    t.fx.task_pred = spark.createDataFrame(
        [(pick(1, 2, 3), pick(*range(6)), pick(*range(6)), pick(*range(30)), pick("PR_FS", "PR_SS", "PR_SF", "PR_FF"), pick(-1, 0, 2))
         for _ in range(60)], "proj_id long, task_id long, pred_task_id long, task_pred_id long, pred_type string, lag_hr_cnt int")
    t.fx.project = spark.sql("""select *, '1' project_name, 40 week_hr_cnt, date'2024-06-30' completion_date from values
        (1L, 'P1', 11L, date'2024-01-02', 8), (1L, 'P1b', 11L, date'2024-01-12', 10), (2L, 'P2', 12L, null, 8), (3L, 'P3', 13L, date'2024-01-05', 8),
        (4L, 'P4', 11L, date'2024-01-05', 8) as x(proj_id, proj_name, baseline_proj_id, last_recalc_date, day_hr_cnt)""")
    t.fx.baseline = spark.sql("""select * from values (1L, 11L, date'2024-01-01'), (1L, 12L, date'2024-01-03'), (2L, 12L, date'2024-01-01'),
        (3L, 11L, null), (4L, 11L, date'2024-01-01') as x(orig_proj_id, baseline_proj_id, last_baseline_update_date)""")
    t.fx.task.createOrReplaceTempView("snapshots")
    schedule.open_grading_tasks(t).createOrReplaceTempView("open_snapshots")
    for name in ("task_pred", "project"):
        getattr(t.fx, name).createOrReplaceTempView(name)
    yield t
    for name in ("snapshots", "open_snapshots", "task_pred", "project"):
        spark.catalog.dropTempView(name)


def same(got, want) -> bool:
    assert sorted(map(repr, rows(got, *want.columns))) == sorted(map(repr, rows(want)))
    return want.count() > 3


def test_counts_per_week_are_those_of_single_snapshots(spark, odd_schedule):
    assert same(schedule.week_stats(odd_schedule), spark.sql("""
        with own as (select proj_id, task_id, count(distinct task_pred_id) n, count(pred_task_id) preds,
            count_if(pred_type = 'PR_FS') fs, count_if(lag_hr_cnt > 0) lags, count_if(lag_hr_cnt < 0) leads from task_pred group by 1, 2),
        followed as (select distinct proj_id, pred_task_id task_id, true f from task_pred),
        x as (select t.*, p.last_recalc_date, p.day_hr_cnt, own.*except(proj_id, task_id), f, act_end_date is null o
            from open_snapshots t left join project p on p.proj_id = t.proj_id left join own on own.proj_id = t.proj_id and
            own.task_id = t.task_id left join followed w on w.proj_id = t.proj_id and w.task_id = t.task_id)
        select proj_id, start_week, count(distinct task_id) total_tasks_cnt, count(distinct if(o, task_id, null)) total_tasks_remaining,
            count_if(o) open_rows, count_if(not o) actual_complete, count_if(target_end_date <= start_week) due,
            count_if(o and cstr_type in ('CS_MEO', 'CS_MSO')) num_hard_consts,
            count_if(o and cstr_type not in ('CS_MEO', 'CS_MSO')) num_soft_consts,
            count_if(o and act_start_date > last_recalc_date) num_invalid_dates,
            count_if(o and total_float_hr_cnt / day_hr_cnt > 44) high_float,
            count_if(o and (task_type in ('TT_Task', 'TT_LOE') and (coalesce(preds, 0) = 0 or f is null)
                or task_type = 'TT_Mile' and f is null or task_type = 'TT_FinMile' and coalesce(preds, 0) = 0)) total_missing_logic_cnt,
            sum(if(o, coalesce(n, 0), 0)) total_remaining_relationships, sum(if(o, coalesce(fs, 0), 0)) total_fs_relationships,
            sum(if(o, coalesce(lags, 0), 0)) lags_cnt, sum(if(o, coalesce(leads, 0), 0)) leads_cnt from x group by 1, 2""".replace(
                "own.*except(proj_id, task_id)", "n, preds, fs, lags, leads")))


def test_links_out_of_sequence_are_those_of_single_snapshots(spark, odd_schedule):
    assert same(schedule._out_of_sequence(odd_schedule), spark.sql("""
        select s.proj_id, s.start_week, count(distinct p.task_id) total_task_cnt, count_if(
            pred_type = 'PR_FS' and p.act_end_date is null and s.act_start_date is not null
            or pred_type = 'PR_SS' and p.act_start_date is null and s.act_start_date is not null
            or pred_type = 'PR_SF' and p.act_start_date is null and s.act_end_date is not null
            or pred_type = 'PR_FF' and p.act_end_date is null and s.act_end_date is not null) out_seq_cnt
        from open_snapshots s join task_pred l on l.proj_id = s.proj_id and l.task_id = s.task_id
        join open_snapshots p on p.proj_id = s.proj_id and p.task_id = l.pred_task_id and p.start_week = s.start_week
        where s.act_end_date is null group by 1, 2"""))


def test_baseline_counts_are_those_of_single_snapshots(spark, odd_schedule):
    pairs = spark.sql("select proj_id, baseline_proj_id from project where proj_id <> 3 or proj_id is null")
    pairs.createOrReplaceTempView("pairs")
    assert same(schedule._missed(odd_schedule, pairs), spark.sql("""
        select c.proj_id, c.start_week, count(*) num_missed_tasks from open_snapshots c join pairs using (proj_id)
        join open_snapshots b on b.proj_id = baseline_proj_id and b.task_code = c.task_code and b.start_week = c.start_week
        where c.act_end_date > b.early_end_date or c.act_end_date is null and b.early_end_date <= c.start_week group by 1, 2"""))
    spark.sql("select * from values (1L, 12L), (2L, 12L), (4L, 11L) as x(proj_id, bl_id)").createOrReplaceTempView("newest")
    assert same(schedule._high_duration(odd_schedule), spark.sql("""
        with tp as (select p.proj_id, proj_name, day_hr_cnt, start_week, task_code, bl_id from project p
            left join open_snapshots t on t.proj_id = p.proj_id left join newest n on n.proj_id = p.proj_id where act_end_date is null)
        select tp.proj_id, proj_name, bl_id baseline_proj_id, tp.start_week, count(*) remaining_tasks_cnt,
            count_if(target_drtn_hr_cnt / day_hr_cnt > 20) long_duration_cnt
        from tp left join open_snapshots b on b.proj_id = bl_id and b.task_code = tp.task_code group by 1, 2, 3, 4"""))
    for name in ("pairs", "newest"):
        spark.catalog.dropTempView(name)


def test_landing_frees_its_shuffles(spark):
    import time

    from trestle.sources.landing import land_fresh

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        names = [f.rsplit("/", 1)[-1] for f in str(disk.getAllFiles().mkString("\n")).splitlines()]
        return {f.split("_")[1] for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = shuffles()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    landed = land_fresh(spark.range(1000).repartition(3, "id"))
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and landed.count() == 1000 and spark.conf.get(key) == was


def test_a_source_set_by_hand_is_landed_apart(spark):
    t, other = Tables(spark, SF_SMALL), Tables(spark, SF_SMALL)
    t.fx.budget = t.fx.budget.limit(3)
    assert t.fx.budget_code.count() <= 3 < other.fx.budget_code.count() and t.scope != other.scope
