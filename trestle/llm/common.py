"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trestle.session import checkpoint_dir

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"

#: Rows come to Python workers in Arrow batches of about this size, however long their texts are.
BATCH_BYTES = 8 << 20


def land(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and return the table read back.

    Cuts the lineage: a lost executor only reruns tasks of the write, and later readers start from files that
    every executor can open.  The folder name is new on each call, so a changed input never meets old rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` where ``fn`` takes the record batches of a partition and yields column dictionaries."""
    target = to_arrow_schema(T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL")
                             else T._parse_datatype_string(schema))

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in
                 ((cols[f.name], f) for f in target)], schema=target)

    return df.mapInArrow(run, schema)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) under fixed names; other columns only where named."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def is_held_out(id_col: str | Column = "doc_id") -> Column:
    """The test fold of the learned operators: crc32 of the id as text, modulo 3, is 1."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def share_code(spark: SparkSession) -> SparkSession:
    """Let the Python workers import this package from where the driver did (a path that all machines share, unless
    the package is installed or was sent with ``--py-files``), and get their rows in batches of bounded size."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
