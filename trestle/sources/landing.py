"""Land a DataFrame once per Spark application as a parquet table in the session's checkpoint folder.

Used for the source analogs (production sources are landed tables), for intermediates shared by many models (the
untagged task snapshots behind the schedule metrics) and for blocks of ordered work.  The write goes through the
standard file committer into the shared checkpoint folder (``spark.checkpoint.dir`` on a cluster), so a lost executor
only reruns its tasks; reading the table back keeps column pruning and filter pushdown, and cuts the lineage.

Named tables belong to a ``scope``: the folder of the sources with the state of its files, so changed sources are landed
anew.  ``TRESTLE_LAND=0`` keeps everything lazy (plan inspection).
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trestle.session import checkpoint_dir

_LANDED: dict = {}
_LOCKS: dict = {}          # one per table: queries built from several threads land each table once
_LOCK = threading.Lock()   # held only to find the lock of a table, or to change settings


def _is_off() -> bool:
    return os.environ.get("TRESTLE_LAND", os.environ.get("TRESTLE_LAND_ANALOGS", "1")) == "0"


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/trestle-landed/{spark.sparkContext.applicationId}"


def source_state(spark: SparkSession, root: str) -> str:
    """A digest of what lies in the folder ``root``: names and modification times, number and size of all files."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    whole = fs.getContentSummary(path)
    return hashlib.sha1(repr((found, whole.getFileCount(), whole.getLength())).encode()).hexdigest()[:12]


_SET: dict = {}            # settings held now: how many hold them, and what they were


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """SQL settings of the session for what is written meanwhile; the last of several threads that hold one resets it."""
    with _LOCK:
        for k, v in values.items():
            held, before = _SET.get(k) or (0, spark.conf.get(k, None))
            _SET[k] = held + 1, before
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _LOCK:
            for k in values:
                held, before = _SET.pop(k)
                if held > 1:
                    _SET[k] = held - 1, before
                elif before is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, before)


#: What is landed is read from its files, so the shuffles behind it leave the disk as soon as it is written.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def land(spark: SparkSession, scope: str, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    if _is_off():
        return df
    key = (spark.sparkContext.applicationId, scope, name)
    with _LOCK:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _LANDED:
            w = df.write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            path = f"{_root(spark)}/{hashlib.sha1(scope.encode()).hexdigest()[:12]}/{name}"
            with settings(spark, FREED):
                w.parquet(path)
            _LANDED[key] = spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)
        return _LANDED[key]


def parts(landed: DataFrame, rows: int = 500_000) -> int:
    """Into how many parts to deal the rows of a landed table, so that a part holds about ``rows`` however long the table
    is: at least as many as any shuffle has.  The rows are counted from the footers of its files."""
    least = int(landed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return least if _is_off() else max(least, landed.count() // rows + 1)


def land_fresh(df: DataFrame) -> DataFrame:
    """``df`` written to a folder of its own and read back."""
    if _is_off():
        return df
    path = f"{_root(df.sparkSession)}/{uuid.uuid4().hex}"
    with settings(df.sparkSession, FREED):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
