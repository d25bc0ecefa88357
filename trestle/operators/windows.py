"""Window operators (W-1..W-9) with the dialect's NULL ordering (D1: NULL is the largest value).

Top-1 windows partition by their key; ``row_number() == 1`` filters are pruned early by Catalyst
(InferWindowGroupLimit), so a hot key (one project or job holding a third of the rows) never reaches one task whole.
Running totals and LEAD need all rows of a key in order; they are dealt to several tasks in blocks
(``trestle.operators.blocks``).  Global (unpartitioned) windows are never used: a global top-1 is a
TakeOrderedAndProject and a global max is a scalar aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trestle.operators.blocks import rows_further, running_sums


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc(c) -> Column:
    """DESC with NULLs first (D1)."""
    return _c(c).desc_nulls_first()


def asc(c) -> Column:
    """ASC with NULLs last (D1)."""
    return _c(c).asc_nulls_last()


def _order(order: Sequence, descending: bool) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        else:
            out.append(desc(o) if descending else asc(o))
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, tie: Sequence = (),
                   descending: bool = True) -> DataFrame:
    """W-1: ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.

    ``tie`` columns make the pick deterministic where the reference leaves it arbitrary.
    """
    w = Window.partitionBy(*keys).orderBy(*_order(order, descending), *_order(tie, descending))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, tie: Sequence = ()) -> DataFrame:
    return latest_per_key(df, keys, order, tie, descending=False)


def top_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = True) -> DataFrame:
    """W-3: rows with ``RANK() = 1`` per key (ties kept), for orderings by columns.

    The best order value of each key is a map-side combined aggregate that is joined back, so a key of which very
    many rows tie is never sorted in one task: the join's left side can be split.
    """
    value = F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(f"_v_{c}"))])
    best = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        (F.max(value) if descending else F.min(value)).alias("_best"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(best, same).filter(value.eqNullSafe(F.col("_best"))).select(*df.columns)



def global_top1(df: DataFrame, order: Sequence, descending: bool = True) -> DataFrame:
    """W-4: one row of the whole input: per-partition top-1 then a merge (TakeOrderedAndProject)."""
    return df.orderBy(*_order(order, descending)).limit(1)


def running_sum(df: DataFrame, keys: Sequence[str], order: str | Column, cols: Sequence[str],
                frame: str = "rows", suffix: str = "_running", tie: Sequence = ()) -> DataFrame:
    """W-5/W-6: running totals per key, in blocks.

    ``frame='rows'`` is ``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW`` (``tie`` columns order its ties);
    ``frame='range'`` is the default frame of ``SUM() OVER (ORDER BY ..)``: peers (equal order values) share the total,
    and the total stays NULL until the first non-NULL value.
    """
    return running_sums(df, keys, _order([order, *tie], False), {f"{c}{suffix}": c for c in cols}, frame)


def where_max(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """W-7/W-8: keep rows whose ``c`` equals the max of ``c`` (over the key, or over everything).

    Over everything the max is a scalar subquery (one aggregate, computed once and broadcast as a literal),
    not a single-partition window.  A NULL max keeps nothing.
    """
    if keys:
        w = Window.partitionBy(*keys)
        return df.withColumn("_mx", F.max(c).over(w)).filter(F.col(c) == F.col("_mx")).drop("_mx")
    mx = df.select(F.max(c)).scalar()
    return df.filter(F.col(c) == mx)


def rows_back(df: DataFrame, keys: Sequence[str], order: str, wanted: Mapping[str, tuple[str, int]],
              descending: bool = True) -> DataFrame:
    """W-9: ``LEAD(c, n) OVER (PARTITION BY keys ORDER BY order DESC)`` for each ``name: (c, n)``: the value n rows
    further in the order, in blocks."""
    return rows_further(df, keys, _order([order], descending), wanted)
