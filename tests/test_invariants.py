"""Invariants that must hold on any data, checked on the smallest test tables."""

from pyspark.sql import functions as F

from trestle.plans import finance, job_cost, operator_queries, schedule
from trestle.plans.registry import load_all


def test_running_total_at_last_month_is_the_plain_sum(tables):
    m = job_cost.job_cost_monthly(tables)
    last = (m.groupBy("job", "cost_type", "phase_group", "phase")
            .agg(F.max_by("cumulative_actual_cost", F.struct("month_date", "jcco")).alias("last_cum"),
                 F.sum("actual_cost").alias("total")))
    assert last.filter(F.col("last_cum") != F.col("total")).count() == 0


def test_spine_rows_equal_sum_of_month_spans(tables):
    con = tables.fx.contract
    spans = con.select((F.lit(2001) - F.year("start_date")) * 12 + F.lit(8) - F.month("start_date") + 1)
    expected = sum(r[0] for r in spans.collect() if r[0] > 0)
    assert load_all()["month_spine"](tables).count() == expected


def test_unpivot_has_sixteen_rows_per_base_row(tables):
    base = schedule.constraints(tables).count()
    assert schedule.grading_long(tables).count() == 16 * base


def test_anti_plus_semi_is_the_input(tables):
    t = tables.fx.task
    tags = tables.fx.task_tag.select("proj_id", "task_id", "start_week")
    anti = t.join(tags, ["proj_id", "task_id", "start_week"], "left_anti").count()
    semi = t.join(tags, ["proj_id", "task_id", "start_week"], "left_semi").count()
    assert anti + semi == t.count()
    assert operator_queries.anti_omit_tagged(tables).count() == anti


def test_union_counts_add_up(tables):
    u = load_all()["union_all"](tables).count()
    assert u == tables.fx.contract.count() + tables.fx.change_item.filter("approved = 'Y'").count()


def test_wip_revenue_plus_backlog_is_contract(tables):
    w = job_cost.wip_schedule(tables)
    bad = w.filter(F.abs(F.col("jtd_revenue") + F.col("backlog_revenue") - F.col("tj_contract_amount")) > 0.05)
    assert bad.count() == 0


def test_change_orders_one_row_per_item(tables):
    co = finance.change_orders(tables)
    assert co.count() == co.select("pmoi_key_id", "jcoi_key_id").distinct().count()
