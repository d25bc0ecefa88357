"""Source freshness marts (R-60, R-73) and the sinks (S-8, S-9, S-10).

One row per data source: the newest data date it holds and when it was last loaded.  Every row is a global
aggregate or a global top-1 (per-partition top-1 then merge, W-4), never a single-partition window; one-row
relations are attached as scalar subqueries (J-7), so no join is involved.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle import DEFAULT_AS_OF
from trestle.functions import date_lit, shift_zone
from trestle.operators import joins as J
from trestle.operators import windows as W
from trestle.plans.registry import query
from trestle.session import checkpoint_dir
from trestle.sources import control as S
from trestle.sources.landing import FREED, land_fresh, parts, settings
from trestle.sources.tables import Tables, source

SOURCE_ZONE = "America/Los_Angeles"
REPORT_ZONE = "America/New_York"
# The data-source labels of the freshness report.
SAFETY_SOURCE = "KPA"
CRM_SOURCE = "Unanet"
# Sources whose data date is reported at the end of its month.
MONTH_END_SOURCES = ("GL Budget", "New Sales", "WIP", "Rolling Forecast", "Pending Backlog")


def _ny(c: Column) -> Column:
    return shift_zone(c, SOURCE_ZONE, REPORT_ZONE)


def refresh_log(t: Tables) -> DataFrame:
    """Load-log analog (last_load_dt, success): one entry per event, errors are failed loads."""
    e = source(t, "events")
    return e.select(F.col("ts").cast("timestamp_ntz").alias("last_load_dt"),
                    (F.col("event_type") != "error").alias("success"))


def _control_row(t: Tables, label: str) -> DataFrame:
    """Newest active file of a control table (W-4); load times derived from the file month and load number."""
    c = t.fx.control.filter(F.col("active") == F.lit(True))
    first = F.to_timestamp("file_month_year").cast("timestamp_ntz")
    c = c.select(F.lit(label).alias("data_source"), F.col("file_month_year").cast("date").alias("data_date_ref"),
                 first.alias("first_load_dt"),
                 (first + F.make_dt_interval(F.col("load_no"))).alias("last_load_dt"))
    return W.global_top1(c, ["data_date_ref"])


def _cols(df: DataFrame) -> DataFrame:
    return df.select("data_source", F.col("data_date_ref").cast("date").alias("data_date_ref"),
                     F.col("first_load_dt").cast("timestamp_ntz").alias("first_load_dt"),
                     F.col("last_load_dt").cast("timestamp_ntz").alias("last_load_dt"))


def load_freshness(t: Tables, name: str) -> DataFrame:
    """When the newest load of a source was, by the load log: it stands for the S-10 scan where rows must compare."""
    return refresh_log(t).agg(F.max("last_load_dt").alias("last_altered"))


def file_freshness(t: Tables, name: str) -> DataFrame:
    """S-10: when the files of the table behind a source last changed, in the source's zone."""
    shown_in = t.spark.conf.get("spark.sql.session.timeZone")
    return S.table_freshness(source(t, name)).select(shift_zone("last_altered", shown_in, SOURCE_ZONE).alias("last_altered"))


#: Tables behind the ledger and the budget.
LEDGER_TABLE, BUDGET_TABLE = "lineitem", "lineitem"


def source_rows(t: Tables, as_of=DEFAULT_AS_OF, with_crm: bool = True, freshness=load_freshness) -> DataFrame:
    """One row per source; ``freshness`` tells when a table last changed (``file_freshness`` on landed tables)."""
    from trestle.plans.crm_safety import current_versions, osha_recordable_incidents
    from trestle.plans.finance import actual_cost, budget_lines
    from trestle.plans.gl import forecast_versions, named_budget

    log = S.load_window(refresh_log(t))                       # one row: first/last successful load
    parts = [_control_row(t, name) for name in ("New Sales", "WIP", "Rolling Forecast", "Pending Backlog")]

    safety = W.global_top1(osha_recordable_incidents(t).select("injury_date"), ["injury_date"])
    safety = J.with_params(safety, log).select(F.lit(SAFETY_SOURCE).alias("data_source"), F.col("injury_date").alias("data_date_ref"),
                                         _ny(F.col("first_load_dt")).alias("first_load_dt"),
                                         _ny(F.col("last_load_dt")).alias("last_load_dt"))
    parts.append(safety)

    now_date = date_lit(as_of)
    gl = actual_cost(t).filter(F.col("actual_date") <= now_date).agg(F.max("actual_date").alias("data_date_ref"))
    gl = J.with_params(gl, freshness(t, LEDGER_TABLE)).select(F.lit("GL Actuals").alias("data_source"), "data_date_ref",
                                             F.lit(None).alias("first_load_dt"),
                                             _ny(F.col("last_altered")).alias("last_load_dt"))
    parts.append(gl)

    # One row per forecast version: when it begins, and its place in the order that tells the newest one.
    fc = forecast_versions(named_budget(budget_lines(t))).groupBy("budget_name").agg(
        F.max(F.struct("mth_year", "fc_number")).alias("_at"), F.min("mth").alias("data_date_ref"))
    bud = W.global_top1(fc, ["_at", "budget_name"]).agg(F.min("data_date_ref").alias("data_date_ref"))
    bud = J.with_params(bud, freshness(t, BUDGET_TABLE)).select(F.lit("GL Budget").alias("data_source"), "data_date_ref",
                                               F.lit(None).alias("first_load_dt"),
                                               _ny(F.col("last_altered")).alias("last_load_dt"))
    parts.append(bud)

    if with_crm:      # the CRM row counts failed loads too
        newest = current_versions(t).agg(F.max("last_modified_date_time").alias("data_date_ref"))
        loads = refresh_log(t).agg(F.min("last_load_dt").alias("first_load_dt"), F.max("last_load_dt").alias("last_load_dt"))
        parts.append(J.with_params(loads, newest).select(F.lit(CRM_SOURCE).alias("data_source"), "data_date_ref",
                                                       "first_load_dt", "last_load_dt"))
    now = _ny(date_lit(as_of).cast("timestamp_ntz"))
    parts.append(log.select(F.lit("power_bi_refresh").alias("data_source"), now.alias("data_date_ref"),
                            F.lit(None).alias("first_load_dt"), now.alias("last_load_dt")))
    return reduce(DataFrame.union, [_cols(p) for p in parts])


@query("source_refresh_meta")
def source_refresh_meta(t: Tables) -> DataFrame:
    """R-60: one row per source with its data date (month end for monthly sources) and last load time."""
    u = source_rows(t)
    ref = F.when(F.col("data_source").isin(*MONTH_END_SOURCES), F.last_day("data_date_ref")).otherwise(F.col("data_date_ref"))
    return u.select("data_source", ref.alias("data_date_ref"), "last_load_dt")


@query("source_refresh_exec")
def source_refresh_exec(t: Tables) -> DataFrame:
    """R-73: the executive variant: no CRM row and no month-end rule."""
    return source_rows(t, with_crm=False).select("data_source", "data_date_ref", "last_load_dt")


OPEN_FILES = 4
_UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}


# --- sinks ------------------------------------------------------------------------------------------------------
def register(df: DataFrame, name: str) -> DataFrame:
    """S-8: the default materialization: a (temporary) view."""
    df.createOrReplaceTempView(name)
    return df


def rebuild_table(df: DataFrame, name: str, partition_by: list[str], folder: str) -> DataFrame:
    """S-9: ``df`` as the catalog table ``name``, rebuilt whole behind a stage; returns the table.

    The model is written to a stage first.  If that fails, the table is as it was.  Then the staged rows replace the
    table's partitions: a dynamic partition overwrite writes beside them and moves the new files in when its job commits.
    Partitions that the rebuild no longer has are dropped, and the stage is removed.  Partition columns hold no nulls; their
    values are few (a snapshot week each), so their list may come to the driver.

    A task writes up to ``OPEN_FILES`` partitions side by side and sorts its rows only if it has more of them: a model whose
    rows are dealt by the partition columns is not sorted.
    """
    spark = df.sparkSession
    stage = f"{folder.rstrip('/')}/stage-{uuid.uuid4().hex}"
    try:
        with settings(spark, {**FREED, **_UNSORTED}):
            df.write.partitionBy(*partition_by).parquet(stage)
        return _replace_partitions(df, name, partition_by, folder, stage)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _replace_partitions(df: DataFrame, name: str, partition_by: list[str], folder: str, stage: str) -> DataFrame:
    spark = df.sparkSession
    columns = [*[c for c in df.columns if c not in partition_by], *partition_by]
    staged = spark.read.schema(df.schema).parquet(stage).select(*columns)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{c}` {staged.schema[c].dataType.simpleString()}" for c in columns)
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) "
                  f"LOCATION '{folder.rstrip('/')}/table'")
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic", **_UNSORTED}):
        staged.write.mode("overwrite").insertInto(name)
    new = {tuple(map(str, r)) for r in staged.select(*partition_by).distinct().collect()}
    old = spark.table(name).select(*partition_by).distinct().collect()
    for r in old:
        if tuple(map(str, r)) not in new:
            spec = ", ".join(f"`{c}` = '{v}'" for c, v in zip(partition_by, r))
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")
    spark.catalog.refreshTable(name)
    return spark.table(name)


@query("grading_table")
def grading_table(t: Tables) -> DataFrame:
    """S-9: the grading table (R-58), which the reference materializes, as a catalog table partitioned by week.

    The joined metrics are landed and dealt by week before they become 16 rows each, so that the long rows are not sorted
    by week to be written."""
    from trestle.plans.schedule import METRICS, grading_long, grading_wide

    wide = land_fresh(grading_wide(t))
    model = grading_long(t, wide.repartitionByRange(parts(wide, 500_000 // len(METRICS)), "start_week", "proj_id"))
    tag = hashlib.sha1(t.scope.encode()).hexdigest()[:12]
    folder = f"{checkpoint_dir(t.spark).rstrip('/')}/trestle-tables/{t.spark.sparkContext.applicationId}/{tag}"
    return rebuild_table(model, f"trestle_grading_metrics_{tag}", ["start_week"], folder).select(*model.columns)


@query("table_freshness")
def table_freshness(t: Tables) -> DataFrame:
    """S-10: last modification time of the files behind each landed table (from the scan's file metadata)."""
    names = ("orders", "lineitem", "customer", "events")
    return reduce(DataFrame.union, [
        S.table_freshness(source(t, n)).select(F.lit(n).alias("table_name"), "last_altered") for n in names])
