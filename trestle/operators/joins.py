"""Join operators (J-1..J-13).

Joins are declared; the physical strategy is Spark's.  With AQE on, a side whose *runtime* size is under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, otherwise both sides are hash-partitioned on the keys
(sort-merge), and skewed partitions of a streamed side are split (``spark.sql.adaptive.skewJoin.enabled``).  Lookups
are made distinct and joined plainly: no size is checked beforehand and nothing is cached.  Where the large side would be
sorted only to meet a side with one row per key, that side is :func:`hashed`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle.operators.blocks import running_sums


def left_using(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-1: ``LEFT JOIN .. USING (keys)``: key columns appear once."""
    return df.join(dim, list(keys), "left")


def left_on(df: DataFrame, dim: DataFrame, pairs: Mapping[str, str], trim: bool = True,
            how: str = "left") -> DataFrame:
    """J-2/J-4: left join on renamed keys, trimmed on both sides (trim happens once, in a projection)."""
    cond = None
    for lcol, rcol in pairs.items():
        lc, rc = df[lcol], dim[rcol]
        if trim:
            lc, rc = F.trim(lc), F.trim(rc)
        cond = (lc == rc) if cond is None else (cond & (lc == rc))
    return df.join(dim, cond, how)


def inner(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-3."""
    return df.join(other, list(keys), "inner")


def hashed(one_per_key: DataFrame) -> DataFrame:
    """``one_per_key`` marked as the side of a shuffled join of which each task keeps its share in a hash table, so that
    the many rows of the other side are streamed and never sorted (a sort of them spills)."""
    return one_per_key.hint("shuffle_hash")


def drop_tagged(df: DataFrame, tags: DataFrame, keys: Sequence[str], at: str | None = None) -> DataFrame:
    """J-5: rows of ``df`` without a matching tag (LEFT JOIN .. WHERE tag IS NULL as an anti join).

    With ``at``, tags hold for one value of that column only: they become one row per ``keys`` with the values of ``at``,
    so that the rows are dealt by ``keys`` alone, streamed past the tags, and rows of one key stay together.
    """
    if at is None:
        return df.join(hashed(tags.select(*keys).distinct()), list(keys), "left_anti")
    tagged = tags.groupBy(*keys).agg(F.collect_set(at).alias("_tagged"))
    found = F.coalesce(F.array_contains("_tagged", F.col(at)), F.lit(False))
    return df.join(hashed(tagged), list(keys), "left").filter(~found).select(*df.columns)


def all_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """J-6: every pair of two dimensions.  The output is the product by definition; make both sides distinct first."""
    return a.crossJoin(b)


def with_params(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """J-7: attach the columns of a one-row relation (a global aggregate) to every row.

    Each column becomes a scalar subquery: computed once, then used as a constant in the projection, so there is
    no join at all (no nested loop, no shuffle).
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def trailing_sums(df: DataFrame, facts: DataFrame, keys: Sequence[str], at: str, date_col: str, value: str,
                  windows: Mapping[str, int]) -> DataFrame:
    """J-9: per row of ``df`` the ``SUM(value)`` of facts with ``at - days < date <= at``, for each ``name: days``.

    An event sweep: the sum of a day enters the windows on that day and leaves each one when it is as many days old.
    The running total of these events up to ``at`` is the sum of the window, so no row meets a range of days, and one
    pass serves all windows.  A window without values is NULL.
    """
    daily = facts.groupBy(*keys, F.col(date_col).alias("_day")).agg(F.sum(value).alias("_v")).filter("_v IS NOT NULL")
    names = list(windows)
    changes = [F.struct(F.col("_day"), *[F.lit(1).alias(f"_n{i}") for i in range(len(names))])]
    changes += [F.struct(F.date_add("_day", days).alias("_day"), *[F.lit(-int(i == k)).alias(f"_n{i}") for i in range(len(names))])
                for k, days in enumerate(windows.values())]
    moved = daily.select(*keys, "_v", F.explode(F.array(*changes)).alias("_e")).select(
        *keys, "_e._day", F.lit(False).alias("_asked"), *[F.col(f"_e._n{i}").alias(f"_n{i}") for i in range(len(names))],
        *[(F.col(f"_e._n{i}") * F.col("_v")).alias(f"_v{i}") for i in range(len(names))])
    asked = df.select(*keys, F.col(at).alias("_day")).distinct().withColumn("_asked", F.lit(True))
    cols = [f"_{x}{i}" for i in range(len(names)) for x in "nv"]
    events = moved.unionByName(asked, allowMissingColumns=True).groupBy(*keys, "_day").agg(
        F.max("_asked").alias("_asked"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    swept = running_sums(events, keys, [F.col("_day")], {f"{c}_now": c for c in cols}).filter("_asked")
    sums = swept.select(*keys, F.col("_day").alias(at), *[
        F.when(F.col(f"_n{i}_now") > 0, F.col(f"_v{i}_now")).alias(name) for i, name in enumerate(names)])
    return df.join(sums, [*keys, at], "left")


def link_counts(nodes: DataFrame, links: DataFrame, keys: Sequence[str], node: str, pred: str,
                pred_name: str = "pred_count", succ_name: str = "succ_count") -> DataFrame:
    """J-12: number of distinct predecessors and successors of each node (edges pre-aggregated, 2 left joins)."""
    preds = links.groupBy(*keys, node).agg(F.countDistinct(pred).alias(pred_name))
    succs = (links.groupBy(*keys, F.col(pred).alias(node))
             .agg(F.countDistinct(node).alias(succ_name)))
    return (nodes.join(preds, [*keys, node], "left").join(succs, [*keys, node], "left")
            .fillna(0, [pred_name, succ_name]))
