"""Set operations and reshaping (U-1..U-8, J-8, W-10, M-2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.functions.dates import month_diff, month_floor


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """P-1: rename/cast projection by a column map: output name -> ``"source"``, ``"source: type"`` or an expression.

    Only the mapped columns are read from the source.
    """
    def column(name: str, given: str | Column) -> Column:
        if isinstance(given, Column):
            return given.alias(name)
        source, _, type_ = (x.strip() for x in given.partition(":"))
        found = F.col(f"`{source}`")
        return (found.cast(type_) if type_ else found).alias(name)

    return df.select(*[column(name, given) for name, given in columns.items()])


def stack_rows(*dfs: DataFrame, distinct: bool = False) -> DataFrame:
    """U-1/U-2: ``UNION ALL`` by position (D19); ``UNION`` when ``distinct``."""
    out = reduce(DataFrame.union, dfs)
    return out.distinct() if distinct else out


def unpivot(df: DataFrame, ids: Sequence[str], metrics: Sequence[tuple[str, str, str | None]],
            name_col: str = "metric", value_col: str = "value", extra_col: str | None = "grade") -> DataFrame:
    """U-3: wide -> long in one scan: ``explode(array(struct(name, value, grade), ...))``.

    ``metrics`` is ``[(metric_name, value_column, grade_column_or_None)]``.  Replaces an N-way UNION ALL that
    would re-evaluate the input plan N times.
    """
    structs = []
    for name, val, extra in metrics:
        fields = [F.lit(name).alias(name_col), F.col(val).cast("double").alias(value_col)]
        if extra_col:
            fields.append((F.col(extra) if extra else F.lit(None)).cast("string").alias(extra_col))
        structs.append(F.struct(*fields))
    exploded = df.select(*ids, F.explode(F.array(*structs)).alias("_m"))
    cols = [name_col, value_col] + ([extra_col] if extra_col else [])
    return exploded.select(*ids, *[F.col(f"_m.{c}").alias(c) for c in cols])


def month_spine(df: DataFrame, start: str | Column, end: str | Column, out: str = "month") -> DataFrame:
    """J-8/U-5/W-10/M-2: one row per month from ``start``'s month to ``end``'s month, however many there are.

    Generated per row with ``sequence`` + ``explode``: no number table, no nested-loop join, no shuffle.
    The month offset ``n`` (0-based) is kept as ``<out>_offset``.
    """
    s = month_floor(start)
    e = month_floor(end)
    last = month_diff(s, e)
    offsets = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return (df.withColumn("_n", F.explode(offsets))
            .withColumn(out, F.add_months(s, F.col("_n")))
            .withColumnRenamed("_n", f"{out}_offset"))


def densify(spine: DataFrame, facts: DataFrame, keys: Sequence[str], measures: Sequence[str],
            fill=0) -> DataFrame:
    """U-6: spine LEFT JOIN facts on keys, missing measures filled with ``fill``."""
    return spine.join(facts, list(keys), "left").fillna(fill, list(measures))


def labelled_slices(df: DataFrame, slices: Mapping[str, Column], label_col: str = "label") -> DataFrame:
    """U-8: the same rows under several labels (UNION ALL of filters) in one pass.

    Each row carries the array of labels whose predicate it meets and is exploded once; no input rescans.
    """
    labels = F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in slices.items()]), lambda x: x.isNotNull())
    return df.withColumn(label_col, F.explode(labels))
