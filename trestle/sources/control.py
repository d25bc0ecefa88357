"""Control-table driven sources (S-2..S-7, S-10, S-11).

A control table lists same-shaped files (one spreadsheet per month).  All files are one DataFrame with a file-name
column, best a table partitioned by it.  The names in the control table are a scalar subquery that filters this column
before the scan opens any file, so files that the control table does not name are not read; the control rows are then
joined on the name.  There is no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _control_rows(control: DataFrame, active_only: bool) -> DataFrame:
    c = control.filter(F.col("active") == F.lit(True)) if active_only else control
    return c.select("table_name", "file_month_year")


def union_controlled(control: DataFrame, *, family: DataFrame, family_key: str = "table_name", active_only: bool = True,
                     columns: Sequence[str] | None = None, with_month: bool = True, required: bool = False) -> DataFrame:
    """S-2/S-3/S-4: UNION ALL of the files named by the control table plus ``source_table``/``file_month_year``.

    ``columns`` projects a fixed column list (S-4); with ``with_month=False`` only ``source_table`` is added and
    the file list is the distinct names (the fixed-column variant lists names via a distinct, M-3).  With ``required``
    the query fails when it runs and the control table names no file (S-5, S-6).
    """
    rows = _control_rows(control, active_only)
    if not with_month:
        rows = rows.select("table_name").distinct()
    keep = [c for c in family.columns if c != family_key] if columns is None else list(columns)
    names = F.collect_set("table_name")       # one per file
    if required:
        names = F.when(F.count(F.lit(1)) == 0, F.raise_error(F.lit("the control table names no file")).cast(
            "array<string>")).otherwise(names)
    listed = rows.agg(names.alias("names")).scalar()
    files = family.select(family_key, *keep).filter(F.array_contains(listed, F.col(family_key)))
    # The control side is one row per landed file; AQE broadcasts it once its runtime size is known.
    joined = files.join(rows, files[family_key] == rows["table_name"], "inner")
    prov = [F.col("table_name").alias("source_table"), *([F.col("file_month_year")] if with_month else [])]
    return joined.select(*[files[c] for c in keep], *prov)


def latest_load(control: DataFrame, load_col: str = "load_no") -> DataFrame:
    """S-5: control rows whose load marker equals the newest one of their table (ties all kept)."""
    w = Window.partitionBy("table_name")
    return (control.withColumn("_mx", F.max(load_col).over(w))
            .filter(F.col(load_col) == F.col("_mx")).drop("_mx"))


def active_table(control: DataFrame) -> DataFrame:
    """S-6: one active control row (the first by name, then file month, for determinism)."""
    return (control.filter(F.col("active") == F.lit(True))
            .orderBy(F.col("table_name").asc_nulls_last(), F.col("file_month_year").asc_nulls_last()).limit(1))


def drop_header_rows(df: DataFrame, col: str, literal: str) -> DataFrame:
    """S-7: ``col != literal``; repeated export headers go, and so do NULLs (NULL != x is not true)."""
    return df.filter(F.col(col) != F.lit(literal))


def load_window(log: DataFrame, ts: str = "last_load_dt", ok: str = "success") -> DataFrame:
    """S-11: first and last successful load."""
    return (log.filter(F.col(ok) == F.lit(True))
            .agg(F.min(ts).alias("first_load_dt"), F.max(ts).alias("last_load_dt")))


def table_freshness(df: DataFrame) -> DataFrame:
    """S-10: last modification time of the files behind a table (from the scan's file metadata)."""
    return df.select(F.max(F.col("_metadata.file_modification_time")).alias("last_altered"))
