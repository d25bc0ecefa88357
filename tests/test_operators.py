"""Generic DataFrame operators on small literal frames."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from trestle.operators import aggregates as A
from trestle.operators.blocks import in_blocks
from trestle.operators import joins as J
from trestle.operators import reshape as U
from trestle.operators import windows as W
from trestle.sources import control as S

D = dt.date


def test_latest_per_key_nulls_first_in_desc(spark):
    df = spark.createDataFrame([(1, 1, D(2024, 1, 1)), (1, 2, None), (1, 3, D(2024, 2, 1)), (2, 4, D(2024, 1, 1))],
                               "k int, v int, ts date")
    got = sorted(rows(W.latest_per_key(df, ["k"], ["ts"], tie=["v"]), "k", "v"))
    assert got == [(1, 2), (2, 4)]                          # D1: the NULL time is the "latest"
    got = sorted(rows(W.earliest_per_key(df, ["k"], ["ts"], tie=["v"]), "k", "v"))
    assert got == [(1, 1), (2, 4)]


def test_top_rank_keeps_ties_and_global_top1(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (2, 1)], "k int, v int")
    assert len(rows(W.top_rank(df, ["k"], ["v"]))) == 3
    assert rows(W.global_top1(df, ["v"]), "v") == [(5,)]


def test_running_sum_rows_vs_range(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 5), ("a", 2, None), ("a", 3, 1)], "k string, m int, x int")
    rng = sorted(rows(W.running_sum(df, ["k"], "m", ["x"], frame="range"), "m", "x", "x_running"),
                 key=lambda r: (r[0], r[1] is None, r[1] or 0))
    assert [r[2] for r in rng] == [15, 15, 15, 16]          # peers share the RANGE total
    first = spark.createDataFrame([("a", 1, None), ("a", 2, 4)], "k string, m int, x int")
    assert [r[1] for r in sorted(rows(W.running_sum(first, ["k"], "m", ["x"], frame="range"), "m", "x_running"))] == [None, 4]


@pytest.fixture
def many_blocks(spark):
    """Partitions stay as many as they are, however small."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def _one_hot_key(spark):
    """A key with most of the rows, with ties and nulls in order and value; dealt over all partitions."""
    return spark.range(3000).selectExpr(
        "if(id % 50 < 47, 1, if(id % 50 = 47, null, id % 50)) as k", "if(id % 41 = 0, null, id * 7919 % 300) as m",
        "id", "if(id % 6 = 0, null, id % 13) as x", "if(id < 2900, null, id) as late")


@pytest.mark.parametrize("frame", ["rows", "range"])
def test_running_sums_of_one_hot_key_in_blocks(spark, many_blocks, frame):
    df = _one_hot_key(spark)
    w = Window.partitionBy("k").orderBy(F.col("m").asc_nulls_last(), *([F.col("id")] if frame == "rows" else []))
    w = (w.rowsBetween if frame == "rows" else w.rangeBetween)(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumns({"x_running": F.sum("x").over(w), "late_running": F.sum("late").over(w)})
    got = W.running_sum(df, ["k"], "m", ["x", "late"], frame, tie=["id"] if frame == "rows" else [])
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)
    blocks = in_blocks(df, ["k"], [F.col("m"), F.col("id")]).filter("k = 1").groupBy("_block").count().collect()
    assert len(blocks) >= 7 and max(r["count"] for r in blocks) < 1000       # of 2,820 rows


@pytest.mark.parametrize("n", [1, 6, 500])
def test_lead_of_one_hot_key_in_blocks(spark, many_blocks, n):
    df = _one_hot_key(spark).withColumn("at", F.col("id") * 3 % 3001)
    w = Window.partitionBy("k").orderBy(F.col("at").desc_nulls_first())
    want = df.withColumns({"a": F.lead("x", n).over(w), "b": F.lead("id", 2).over(w)})
    got = W.rows_back(df, ["k"], "at", {"a": ("x", n), "b": ("id", 2)})
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_trailing_sums_against_a_range_join(spark, many_blocks):
    facts = spark.range(4000).selectExpr("id % 3 as k", "date_add('2024-01-01', cast(id * 7919 % 400 as int)) as d",
                                         "if(id % 5 = 0, null, id) as v")
    df = spark.range(300).selectExpr("if(id % 7 = 6, null, id % 7) as k", "date_add('2023-12-01', cast(id * 3 as int)) as at")
    got = J.trailing_sums(df, facts, ["k"], "at", "d", "v", {"six": 42, "one": 7})
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    p, f = df.alias("p"), facts.alias("f")
    want = p.join(f, F.expr("p.k = f.k AND f.d > date_sub(p.at, 42) AND f.d <= p.at"), "left").groupBy("p.k", "p.at").agg(
        F.sum("v").alias("six"), F.sum(F.expr("if(f.d > date_sub(p.at, 7), v, null)")).alias("one"))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_where_max_global_and_null(spark):
    df = spark.createDataFrame([("9",), ("10",), (None,)], "fc string")
    assert rows(W.where_max(df, "fc")) == [("9",)]
    empty = spark.createDataFrame([(None,)], "fc string")
    assert rows(W.where_max(empty, "fc")) == []            # a NULL max keeps nothing


def test_rows_back_is_rows_not_weeks(spark):
    df = spark.createDataFrame([(1, D(2024, 1, w), w) for w in (1, 8, 22)], "p int, wk date, r int")
    got = sorted(rows(W.rows_back(df, ["p"], "wk", {"prev": ("r", 1)}), "r", "prev"))
    assert got == [(1, None), (8, 1), (22, 8)]


def test_month_spine_long_and_empty(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 15), D(2020, 3, 2)), (2, D(2020, 5, 1), D(2020, 4, 1)),
                                (3, D(2000, 1, 1), D(2030, 1, 1))], "id int, s date, e date")
    out = U.month_spine(df, "s", "e")
    counts = dict(rows(out.groupBy("id").count()))
    assert counts == {1: 3, 3: 361}                          # reversed bounds give no months
    assert sorted(r[0] for r in rows(out.filter("id = 1"), "month")) == [D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)]


def test_unpivot_one_row_per_metric(spark):
    df = spark.createDataFrame([(1, 2.0, "A", 3, "B")], "id int, a double, ga string, b int, gb string")
    out = U.unpivot(df, ["id"], [("a", "a", "ga"), ("b", "b", "gb"), ("c", "a", None)])
    assert sorted(rows(out)) == [(1, "a", 2.0, "A"), (1, "b", 3.0, "B"), (1, "c", 2.0, None)]


def test_labelled_slices(spark):
    df = spark.createDataFrame([(2023,), (2024,), (2025,)], "y int")
    out = U.labelled_slices(df, {"prior": F.col("y") < 2025, "recent": F.col("y") >= 2024})
    assert sorted(rows(out)) == [(2023, "prior"), (2024, "prior"), (2024, "recent"), (2025, "recent")]


def test_densify_fills_zero(spark):
    spine = spark.createDataFrame([(1, 1), (1, 2)], "k int, m int")
    facts = spark.createDataFrame([(1, 2, 7)], "k int, m int, x int")
    assert sorted(rows(U.densify(spine, facts, ["k", "m"], ["x"]))) == [(1, 1, 0), (1, 2, 7)]


def test_listagg_distinct_sorted_and_empty(spark):
    df = spark.createDataFrame([(1, 10), (1, 9), (1, 10), (2, None)], "k int, v int")
    got = dict(rows(A.listagg_distinct(df, ["k"], {"l": "v"})))
    assert got == {1: "9, 10", 2: ""}                       # numbers sort numerically; no values gives '' (D8)


def test_listagg_distinct_of_very_many_values_and_repeats(spark, many_blocks, monkeypatch):
    monkeypatch.setattr(A, "RUN", 16)
    df = spark.range(20_000).selectExpr(
        "if(id % 10 = 9, id % 20, null) as k", "id % 700 as whole", "concat('v', id % 900) as text",
        "if(id % 3 = 0, id % 50 / 4, null) as part", "cast(null as string) as none")
    got = {r["k"]: r for r in A.listagg_distinct(df, ["k"], {c: c for c in ("whole", "text", "part", "none")}).collect()}
    seen = {}
    for r in df.collect():
        for c in ("whole", "text", "part"):
            seen.setdefault((r["k"], c), set()).update([r[c]] if r[c] is not None else [])
    assert set(got) == {None, 9, 19}
    for (k, c), values in seen.items():
        assert got[k][c] == ", ".join(map(str, sorted(values))) and got[k]["none"] == ""


def test_link_counts_and_anti(spark):
    nodes = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "p int, t int")
    links = spark.createDataFrame([(1, 2, 1), (1, 3, 1), (1, 3, 2)], "p int, t int, pred int")
    got = sorted(rows(J.link_counts(nodes, links, ["p"], "t", "pred")))
    assert got == [(1, 1, 0, 2), (1, 2, 1, 1), (1, 3, 2, 0)]
    tags = spark.createDataFrame([(1, 2)], "p int, t int")
    assert sorted(rows(J.drop_tagged(nodes, tags, ["p", "t"]))) == [(1, 1), (1, 3)]



def test_union_controlled_rows_of_listed_files(spark):
    control = spark.createDataFrame([("t1", "2025-01-01", True), ("t2", "2025-02-01", True), ("t3", "2025-03-01", False)],
                                    "table_name string, file_month_year string, active boolean")
    family = spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3), ("t1", 4)], "f string, x int")
    a = S.union_controlled(control, family=family, family_key="f")
    assert sorted(rows(a)) == [(1, "t1", "2025-01-01"), (2, "t2", "2025-02-01"), (4, "t1", "2025-01-01")]
    latest = S.latest_load(control.withColumn("load_no", F.lit(1)))
    assert latest.count() == 3


def _files(spark, folder):
    """A family of files, one of which can't be read."""
    rows_ = [("t1", 1), ("t2", 2), ("t3", 3), ("t1", 4)]
    spark.createDataFrame(rows_, "f string, x int").write.partitionBy("f").parquet(str(folder))
    (folder / "f=broken").mkdir()
    (folder / "f=broken" / "part.parquet").write_text("no parquet")
    return spark.read.schema("x int, f string").parquet(str(folder))


@pytest.mark.parametrize("active_only", [True, False])
def test_union_controlled_opens_only_the_files_that_are_named(spark, tmp_path, active_only):
    family = _files(spark, tmp_path / "family")
    control = spark.createDataFrame([("t1", "m1", True, 1), ("t3", "m3", not active_only, 1), ("gone", "m", True, 1)],
                                    "table_name string, file_month_year string, active boolean, load_no int")
    for given in (control, S.latest_load(control)):
        got = S.union_controlled(given, family=family, family_key="f", active_only=active_only)
        assert sorted(rows(got, "x")) == ([(1,), (4,)] if active_only else [(1,), (3,), (4,)])
        scan = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
        assert any("array_contains" in x and "ubquery" in x for x in scan)
    with pytest.raises(Exception, match="part.parquet|not a Parquet|FAILED_READ"):
        family.count()


def test_no_named_file_is_an_error_when_it_is_required(spark, tmp_path):
    family = _files(spark, tmp_path / "family")
    none = spark.createDataFrame([("t1", "m1", False, 1)],
                                 "table_name string, file_month_year string, active boolean, load_no int")
    assert S.union_controlled(none, family=family, family_key="f").count() == 0
    for control in (none, S.active_table(none), S.latest_load(none.filter("load_no > 1"))):
        late = S.union_controlled(control, family=family, family_key="f", required=True)      # no error yet
        with pytest.raises(Exception, match="names no file"):
            late.collect()


def test_drop_header_rows_drops_nulls(spark):
    df = spark.createDataFrame([("Link",), ("http://x",), (None,)], "link string")
    assert rows(S.drop_header_rows(df, "link", "Link")) == [("http://x",)]


def test_combined_budget_lines_give_the_same_plans_and_sums(spark):
    from datetime import date

    from pyspark.sql import functions as F

    from tests.conftest import SF_SMALL
    from trestle.plans.finance import budget_lines
    from trestle.plans.gl import gl_budget
    from trestle.sources.tables import Tables

    made = [("1", "41010.0210", f"{year} {fc}", date(1999, m, 1), cents + m) for m in (1, 2) for year in (1998, 1999)
            for fc in ("FC9", "FC10", "FC2.6", "BASE") for cents in (500, 20, 300)]
    made += [(co, "61000.0410", "1998 FC9", date(1999, 3, 1), cents) for co, cents in
             [("2", 7), ("2", None), ("5", 3), (None, 4), (None, 9)]]
    made += [("2", "51000.0410", "1999 FC3.1", date(1999, 3, 1), cents) for cents in (None, 5, 6)]
    made += [("7", "51000.0410", code, date(1999, 4, 1), None) for code in ("1999 FC3.1", "1999 FC3.1", None)]
    t = Tables(spark, SF_SMALL)
    t.fx.budget = spark.createDataFrame(made * 2, "gl_co string, gl_account string, budget_code string, mth date, budget_cents long")
    lines, few = gl_budget(t), gl_budget(t, combined=True)
    assert few.columns == lines.columns
    # As many rows as there are companies, accounts, codes and months with a year.
    assert budget_lines(t, combined=True).count() == len({m[:4] for m in made if m[2]})
    keys = [c for c in lines.columns if c != "budget_cents"]

    def sums(df):
        return sorted(map(repr, df.groupBy(*keys).agg(F.sum("budget_cents").alias("cents")).collect()))

    assert sums(lines) == sums(few) and few.count() < lines.count()
    plans = [sorted(map(repr, d.filter("budget_type = 'Plan'").collect())) for d in (lines, few)]
    assert plans[0] == plans[1] and len(plans[0]) > 2
