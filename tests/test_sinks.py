"""Sinks (S-8, S-9) and table freshness (S-10)."""

import datetime as dt
import os
from zoneinfo import ZoneInfo

import pytest

from conftest import SF_SMALL
from trestle.sources import control as S
from trestle.plans import meta, schedule


def test_rebuilt_table(spark, tmp_path):
    name, folder = "trestle_test_rebuilt", str(tmp_path)
    first = spark.range(40).selectExpr("date_add('2024-01-01', cast(id % 4 as int)) as week", "id", "concat('v', id) as v")

    def held():
        return sorted(map(tuple, spark.table(name).select("week", "id", "v").collect()))

    assert sorted(map(tuple, meta.rebuild_table(first, name, ["week"], folder).select("week", "id", "v").collect())) == sorted(
        map(tuple, first.collect()))
    before = held()
    broken = first.selectExpr("week", "id + 100 as id", "if(id = 39, raise_error('broken'), v) as v")
    with pytest.raises(Exception, match="broken"):
        meta.rebuild_table(broken, name, ["week"], folder)
    assert held() == before                                     # a failed rebuild leaves the old table
    second = first.filter("id % 4 < 3").selectExpr("week", "id * 2 as id", "v")
    meta.rebuild_table(second, name, ["week"], folder)
    assert held() == sorted(map(tuple, second.collect())) and len(before) == 40        # the fourth week is gone
    spark.sql(f"DROP TABLE {name}")


def test_a_rebuild_leaves_no_stage(spark, tmp_path):
    name, folder = "trestle_test_stage", str(tmp_path)
    model = spark.range(40).selectExpr("date_add('2024-01-01', cast(id % 4 as int)) as week", "id")
    assert meta.rebuild_table(model, name, ["week"], folder).count() == 40
    with pytest.raises(Exception, match="broken"):
        meta.rebuild_table(model.selectExpr("week", "if(id = 39, raise_error('broken'), id) as id"), name, ["week"], folder)
    assert [p for p in os.listdir(folder) if p.startswith("stage-")] == []
    assert spark.table(name).count() == 40
    spark.sql(f"DROP TABLE {name}")


def test_grading_table_is_rebuilt_by_every_run(spark, tables):
    want = sorted(map(str, schedule.grading_long(tables).collect()))
    assert sorted(map(str, meta.grading_table(tables).collect())) == want
    again = meta.grading_table(tables)
    assert sorted(map(str, again.collect())) == want and again.columns == schedule.grading_long(tables).columns


def test_register_view(spark, tables):
    meta.register(tables.fx.contract, "contract_master_view")
    assert spark.table("contract_master_view").count() == tables.fx.contract.count()


def test_table_freshness_reads_file_metadata(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    (ts,) = S.table_freshness(df).collect()[0]
    assert ts is not None


def test_table_freshness_query(tables):
    got = {r["table_name"]: r["last_altered"] for r in meta.table_freshness(tables).collect()}
    assert set(got) == {"orders", "lineitem", "customer", "events"} and all(got.values())


def test_ledger_freshness_from_the_files(tables):
    """R-60/R-73 with the S-10 scan: the ledger and budget rows carry the change time of their files."""
    got = {r["data_source"]: r["last_load_dt"] for r in meta.source_rows(tables, freshness=meta.file_freshness).collect()}
    changed = dt.datetime.fromtimestamp(os.path.getmtime(f"{SF_SMALL}/lineitem.parquet"), ZoneInfo(meta.REPORT_ZONE))
    for name in ("GL Actuals", "GL Budget"):
        assert abs(got[name] - changed.replace(tzinfo=None)) < dt.timedelta(seconds=2)


def test_changed_sources_are_landed_anew(spark, tmp_path):
    from trestle.sources.landing import land
    from trestle.sources.tables import Tables

    def landed():
        t = Tables(spark, str(tmp_path))
        return land(spark, t.scope, "copy", t("orders")).count()

    spark.range(3).write.parquet(str(tmp_path / "orders.parquet"))
    assert landed() == landed() == 3
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert landed() == 5
