"""Aggregation operators (A-1..A-12).  Every aggregate is partial (map side) + final (after one shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = 1 << 12      # values that one task joins into one text


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``keys`` before it is aggregated by them: for groups of few rows each, of which nearly all would be
    in the map side's table of one task at once, whose memory then grows with the rows of a file."""
    return df.repartition(*keys)


def cond_sum(df: DataFrame, keys: Sequence, measures: Mapping[str, tuple[Column, Column | int]]) -> DataFrame:
    """A-2: ``SUM(CASE WHEN pred THEN val ELSE 0 END)`` per measure, all in one pass."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(pred, val if isinstance(val, Column) else F.lit(val)).otherwise(0)).alias(name)
        for name, (pred, val) in measures.items()
    ])


def pivot_cond(df: DataFrame, keys: Sequence, preds: Mapping[str, Column], val: Column | str,
               else_zero: bool = False) -> DataFrame:
    """A-3/U-4: conditional-aggregate pivot; without ELSE a measure is NULL when no row matches."""
    v = F.col(val) if isinstance(val, str) else val
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(p, v).otherwise(0) if else_zero else F.when(p, v)).alias(name) for name, p in preds.items()
    ])


def listagg_distinct(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column | str], sep: str = ", ") -> DataFrame:
    """A-6: one row per key with ``LISTAGG(DISTINCT c, sep) WITHIN GROUP (ORDER BY c)`` for each ``name: c``; '' when
    there are no values (D8).

    Values are made distinct by an aggregate first, however often they repeat.  The distinct ones are sorted by range
    over all tasks and joined in runs of ``RUN`` values, and only the texts of the runs meet per key, in order; so a
    group of very many values is sorted and joined by many tasks.  Numbers sort as numbers, then become text.
    """
    items = [F.struct(F.lit(-1).alias("_i"), F.lit(None).cast("decimal(38,9)").alias("_d"),
                      F.lit(None).cast("double").alias("_f"), F.lit("").alias("_s"))]      # keeps keys without values
    for i, c in enumerate(values.values()):
        c = F.col(c) if isinstance(c, str) else c
        kind = df.select(c.alias("c")).schema["c"].dataType
        whole = isinstance(kind, (T.IntegralType, T.DecimalType))
        items.append(F.struct(
            F.lit(i).alias("_i"), (c if whole else F.lit(None)).cast("decimal(38,9)").alias("_d"),
            (c if isinstance(kind, T.FractionalType) and not whole else F.lit(None)).cast("double").alias("_f"),
            c.cast("string").alias("_s")))
    order = [*keys, "_i", "_d", "_f", "_s"]
    single = df.select(*keys, F.explode(F.array(*items)).alias("_x")).select(*keys, "_x.*").filter(
        "_s IS NOT NULL").distinct()
    runs = single.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_run", F.floor(F.monotonically_increasing_id() / RUN))
    text = F.array_sort(F.collect_list(F.struct("_d", "_f", "_s")))
    texts = runs.groupBy(*keys, "_i", "_run").agg(F.array_join(F.transform(text, lambda x: x["_s"]), sep).alias("_t"))
    return texts.groupBy(*keys).agg(*[
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_i") == i, F.struct("_run", "_t")))),
                                 lambda x: x["_t"]), sep).alias(name) for i, name in enumerate(values)])


def global_agg(df: DataFrame, *aggs: Column) -> DataFrame:
    """A-7: one-row aggregate."""
    return df.agg(*aggs)


def dedupe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A-9: ``GROUP BY`` used as a dedupe: the distinct key tuples."""
    return df.select(*keys).distinct()
