"""Physical plan checks: no Python in the hot path, no single-partition windows, no nested-loop
joins except the region x market product, pushed-down scans, and no hot key on the side that cannot be split."""

import pytest

from trestle.plans.registry import load_all

# The region x market dimension (R-30) is a product by definition.
NESTED_LOOP_OK = {"cross_region_market"}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(load_all()))
def test_plan_shape(tables, key):
    plan = physical(load_all()[key](tables))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:   # a window fed by a single-partition exchange would run in one task
            assert not any("Exchange SinglePartition" in ln for ln in lines[i + 1:i + 4]), key
    if key not in NESTED_LOOP_OK:
        assert "BroadcastNestedLoopJoin" not in plan, key
    assert key in NESTED_LOOP_OK or "CartesianProduct" not in plan


def _tree(node):
    children = node.children()
    return node.nodeName(), node.simpleString(10_000), [_tree(children.apply(i)) for i in range(children.size())]


def _raw_tasks(tree) -> bool:
    """Whether rows of the task snapshots reach this node without an aggregate or a distinct above them."""
    name, text, children = tree
    if "Aggregate" in name:
        return False
    if "Scan" in name:
        return "open_grading_tasks" in text or "analog-task/" in text
    return any(_raw_tasks(c) for c in children)


def _bad_joins(tree):
    name, text, children = tree
    found = [x for c in children for x in _bad_joins(c)]
    if "Join" in name and "LeftOuter" in text and _raw_tasks(children[1]):
        keys = text[text.index("["):text.index("]") + 1]
        if "task" not in keys:
            found.append(text)
    return found


@pytest.mark.parametrize("key", [k for k in sorted(load_all()) if k.startswith("sched_") or k in (
    "grading_long", "trailing_cost", "rank_top", "baseline_join", "pred_status_join")])
def test_tasks_are_never_the_right_side_of_a_left_join_by_project(spark, tables, key):
    """Spark splits a hot key of the left side of a left outer join only, so snapshots must not stand on the right."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load_all()[key](tables)._jdf.queryExecution().sparkPlan()
        assert _bad_joins(_tree(plan)) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scan_prunes_columns_and_pushes_filters(tables):
    plan = physical(load_all()["cost_nonzero"](tables))
    assert "ReadSchema" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_quantity" not in scan and "l_tax" not in scan            # only the needed columns are read
    plan = physical(load_all()["latest_week_only"](tables))
    assert "Subquery" in plan or "ScalarSubquery" in plan or "subquery" in plan.lower()


def test_top1_windows_get_a_group_limit(tables):
    # row_number() = 1 filters are pushed below the shuffle as a map-side limit (hot keys stay bounded)
    for key in ("gl_budget", "latest_per_key", "opportunities_current"):
        assert "WindowGroupLimit" in physical(load_all()[key](tables)), key
