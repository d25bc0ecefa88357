"""Nearest neighbours by inner product along shifted space-filling curves.

Vectors are put on a sphere (one more component makes all norms equal, so the largest inner product is the nearest
point), projected to a few dimensions by several random rotations, shifted, and ordered by their Hilbert index.  Spark
range-partitions and sorts each ordering and numbers its vectors.  A query looks at the window of neighbours around its
own place in every ordering; windows meet whole blocks of the ordering, so that neighbouring windows merge, and all
queries of a block are scored in one matrix product.  The candidates of all orderings are merged and ranked by their
exact inner products.

How wide the windows must be depends on the data, not on the table: for ``CALIBRATE`` queries the true neighbours are
found by brute force, their distances along the curves are read off, and the number of curves and the window are chosen
that reach ``TARGET`` of them at the least cost.  Clustered vectors get narrow windows; vectors without any structure
get windows that cover most of the table, because no ordering can do better for them.

Equal vectors are one class (grouped by the vector itself) that carries its ``TOP + 1`` smallest ids, so a vector that
very many rows share costs no more than another.

Defined cases: vectors that are null, empty, zero, of a length other than the most frequent one, or that hold null or
non-finite components take no part, nor do rows without an id; rows that repeat an id and its vector count once; an id
is never its own neighbour; a query with fewer candidates returns all; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trestle.llm.common import land, map_batches, shuffle_width

TOP = 20
CURVES, DIMS, BITS = 8, 8, 7          # orderings; components and bits of a Hilbert index
SAMPLE = 4096                         # vectors from which the place and scale of the projections are taken
CALIBRATE, TARGET = 256, 0.96         # queries that are also searched by brute force; their recall
BLOCK, WIDE = 4096, 8                 # rows of a block; blocks of rows whose queries are scored together
_FOUND = "q long, keys array<long>, firsts array<long>, scores array<double>"


def hilbert(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) with ``bits`` bits per component."""
    x = x.astype(np.int64).copy()
    dims, q = x.shape[1], 1 << (bits - 1)
    while q > 1:                      # undo the rotations of each level, from the coarsest
        low = q - 1
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):          # Gray code
        x[:, i] ^= x[:, i - 1]
    turn, q = np.zeros(len(x), np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, -1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    out = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[:, i] >> bit) & 1)
    return out


@dataclass
class Curves:
    """Projections of the sphere, with the place and scale of each component and a shift per curve."""

    norm: float                # the largest norm
    turns: np.ndarray          # curve x (dim + 1) x DIMS
    middle: np.ndarray
    scale: np.ndarray
    shifts: np.ndarray

    def on_sphere(self, v: np.ndarray) -> np.ndarray:
        v = v / self.norm
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", v, v)))
        return np.concatenate([v, rest[:, None]], axis=1)

    @staticmethod
    def of_query(v: np.ndarray) -> np.ndarray:
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        return np.concatenate([v, np.zeros((len(v), 1))], axis=1)

    def indexes(self, points: np.ndarray) -> np.ndarray:
        """curve x point"""
        out = []
        for turn, mid, scale, shift in zip(self.turns, self.middle, self.scale, self.shifts):
            at = np.clip((points @ turn - mid) / (6 * scale) + 0.5, 0, 1) / 2 + shift / 2
            out.append(hilbert(np.minimum(at * (1 << BITS), (1 << BITS) - 1)))
        return np.array(out)


def fit_curves(sample: np.ndarray, norm: float, seed: int = 7) -> Curves:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    turns = np.array([np.linalg.qr(rng.normal(size=(max(dim + 1, DIMS), DIMS)))[0][:dim + 1] for _ in range(CURVES)])
    c = Curves(norm, turns, np.zeros((CURVES, DIMS)), np.ones((CURVES, DIMS)), rng.random((CURVES, DIMS)))
    points = c.on_sphere(sample)
    for k, turn in enumerate(turns):
        p = points @ turn
        c.middle[k], c.scale[k] = p.mean(0), np.maximum(p.std(0), 1e-9)
    return c


def _matrix(column, kind: str) -> np.ndarray:
    rows = column.to_pylist() if isinstance(column, (pa.Array, pa.ChunkedArray)) else list(column)
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def _best(scores: np.ndarray, firsts: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` best per row: larger scores first, ties to the smaller first id."""
    n = min(n, scores.shape[1])
    if n < scores.shape[1]:
        # All that reach the n-th score may be needed for ties; nearly always that is n places.
        least = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
        more = int((scores >= least[:, None]).sum(1).max())
        some = np.argpartition(-scores, more - 1, axis=1)[:, :more] if more < scores.shape[1] else np.broadcast_to(
            np.arange(scores.shape[1]), scores.shape)
    else:
        some = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    own = np.take_along_axis(scores, some, 1)
    order = np.lexsort((firsts[some], -own), axis=1)[:, :n]
    return np.take_along_axis(some, order, 1)


def classes(rows: DataFrame, id_col: str, vector_col: str, every: int) -> tuple[DataFrame, DataFrame, str]:
    """``key, ids, first, v, is_query`` per distinct vector, ``query_id, key`` per query, and the vectors' type."""
    kind = "<f4" if "float" in rows.schema[vector_col].dataType.simpleString() else "<f8"
    v = F.col(vector_col)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                       & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), "n").first()
    rows = rows.filter(F.size("v") == (usual["n"] if usual else 0))

    def run(batches):
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(b.num_rows, -1) + 0
            yield {"id": b.column(0), "v": [x.tobytes() for x in flat]}

    rows = land(map_batches(rows, run, "id long, v binary").distinct())
    is_query = F.col("id") % every == 0
    few = rows.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("k") <= TOP + 1)
    few = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.groupBy("v").agg(F.max(is_query).alias("is_query"))
    one = land(few.join(asked, "v").select(F.monotonically_increasing_id().alias("key"), "ids", F.col("ids")[0].alias("first"),
                                           "v", "is_query"))
    queries = rows.filter(is_query).join(one.filter("is_query").select("v", "key"), "v")
    return one, queries.select(F.col("id").alias("query_id"), "key"), kind


def places(one: DataFrame, curves: Curves, kind: str) -> DataFrame:
    """``curve, key, asks, place``: the number of each vector (and of each query) along every curve."""
    def index(batches):
        for b in batches:
            v = _matrix(b.column(1), kind)
            out = {c: [] for c in ("curve", "at", "asks", "key")}
            asked = np.asarray(b.column(2).to_pylist(), bool)
            keys = np.asarray(b.column(0))
            for asks, own, points in ((False, keys, curves.on_sphere(v)),
                                      (True, keys[asked], curves.of_query(v[asked]))):
                at = curves.indexes(points) if len(own) else np.zeros((CURVES, 0), np.int64)
                for c in range(CURVES):
                    out["curve"].append(np.full(len(own), c))
                    out["at"].append(at[c])
                    out["asks"].append(np.full(len(own), asks))
                    out["key"].append(own)
            yield {c: np.concatenate(x) for c, x in out.items()}

    order = ["curve", "at", "key", "asks"]
    rows = map_batches(one.select("key", "v", "is_query"), index, "curve int, at long, asks boolean, key long")
    rows = rows.repartitionByRange(shuffle_width(one.sparkSession), *order).sortWithinPartitions(*order)

    def number(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve, asks = np.asarray(b.column(0)), np.asarray(b.column(2).to_pylist(), bool)
            k = np.zeros(len(curve), np.int64)
            for c in np.unique(curve):
                own = curve == c
                upto = np.cumsum(~asks[own])
                k[own] = seen.get(c, 0) + upto - ~asks[own]
                seen[c] = seen.get(c, 0) + int(upto[-1])
            yield {"part": np.full(len(curve), part), "curve": curve, "key": b.column(3), "asks": asks, "k": k}

    numbered = land(map_batches(rows, number, "part int, curve int, key long, asks boolean, k long"))
    count = numbered.groupBy("curve", "part").agg(F.sum(F.when(F.col("asks"), 0).otherwise(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    count = count.select("curve", "part", F.coalesce(before, F.lit(0)).alias("base"))       # a row per curve and task
    return land(numbered.join(count, ["curve", "part"]).select("curve", "key", "asks",
                                                             (F.col("base") + F.col("k")).alias("place")))


def calibrate(one: DataFrame, placed: DataFrame, n: int, kind: str) -> tuple[int, int]:
    """Number of curves and half width of the window that reach ``TARGET`` at the least cost."""
    asked = one.filter("is_query").orderBy(F.xxhash64("v"), "key").limit(CALIBRATE).select("key", "v").collect()
    if not asked:
        return 2, BLOCK
    q, own = _matrix([bytes(r["v"]) for r in asked], kind), np.array([r["key"] for r in asked])

    def brute(batches):
        best = None
        for b in batches:
            if not b.num_rows:
                continue
            keys, firsts, v = np.asarray(b.column(0)), np.asarray(b.column(1)), _matrix(b.column(2), kind)
            scores = np.where(own[:, None] == keys[None, :], -np.inf, q @ v.T)
            k = _best(scores, firsts, TOP)
            got = [np.take_along_axis(scores, k, 1), keys[k]]
            best = got if best is None else [np.concatenate(x, axis=1) for x in zip(best, got)]
            if best[0].shape[1] > 8 * TOP:
                top = np.argsort(-best[0], axis=1)[:, :TOP]
                best = [np.take_along_axis(x, top, 1) for x in best]
        if best is not None:
            top = np.argsort(-best[0], axis=1)[:, :TOP]
            yield {"q": np.repeat(own, top.shape[1]), "score": np.take_along_axis(best[0], top, 1).ravel(),
                   "key": np.take_along_axis(best[1], top, 1).ravel()}

    found = map_batches(one.select("key", "first", "v"), brute, "q long, score double, key long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key"))
    found = found.filter("score > -1e308").withColumn("k", rank).filter(F.col("k") <= TOP).select("q", "key")
    mine = placed.filter("asks").select("curve", F.col("key").alias("q"), F.col("place").alias("from"))
    far = found.join(placed.filter("NOT asks"), "key").join(mine, ["curve", "q"]).select(
        "curve", "q", "key", F.abs(F.col("place") - F.col("from")).alias("far")).toPandas()   # CALIBRATE * TOP * CURVES
    if not len(far):
        return 2, BLOCK
    table = far.pivot_table(index=["q", "key"], columns="curve", values="far").to_numpy()
    choices = []
    for c in (2, 4, CURVES):
        half = int(np.quantile(table[:, :c].min(1), TARGET, method="higher")) + 1
        choices.append((c * min(2 * half + 1, n), c, half))
    _, c, half = min(choices)
    return c, half


def search(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``TOP`` nearest of each row whose id is divisible by ``every``."""
    spark = rows.sparkSession
    one, queries, kind = classes(rows, id_col, vector_col, every)
    n = one.count()
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def norms(batches):
        for b in batches:
            yield {"x": [float(np.linalg.norm(_matrix(b.column(0), kind), axis=1).max())] if b.num_rows else []}

    norm = map_batches(one.select("v"), norms, "x double").agg(F.max("x")).first()[0]
    sample = one.orderBy(F.xxhash64("v"), "key").limit(SAMPLE).select("v").collect()
    curves = fit_curves(_matrix([bytes(r["v"]) for r in sample], kind), norm)
    placed = places(one, curves, kind)
    used, half = calibrate(one, placed, n, kind)

    wide, last = BLOCK * WIDE, (n - 1) // BLOCK
    placed = placed.filter(F.col("curve") < used)
    block = F.floor(F.col("place") / BLOCK)
    low = F.greatest(F.floor((block * BLOCK - half) / wide), F.lit(0))
    high = F.least(F.floor((block * BLOCK + BLOCK - 1 + half) / wide), F.lit(n // wide))
    given = placed.filter("NOT asks").select("curve", "key", block.alias("block"), F.explode(
        F.sequence(low, high)).alias("part"), F.lit(False).alias("asks"))
    first = F.greatest(F.floor((F.col("place") - half) / BLOCK), F.lit(0))
    final = F.least(F.floor((F.col("place") + half) / BLOCK), F.lit(last))
    asked = placed.filter("asks").select("curve", "key", F.explode(F.sequence(F.least(first, F.lit(last)), final)).alias(
        "block"), F.floor(F.col("place") / wide).alias("part"), F.lit(True).alias("asks"))
    meet = given.unionByName(asked).join(one.select("key", "first", "v"), "key")

    def score(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        if not asks.any() or asks.all():
            return pd.DataFrame({c.split()[0]: pd.Series([], dtype=object) for c in _FOUND.split(", ")})
        q, x = _matrix(group["v"][asks], kind), _matrix(group["v"][~asks], kind)
        keys, firsts = group["key"][~asks].to_numpy(), group["first"][~asks].to_numpy()
        out = []
        for lo in range(0, len(q), 512):
            some = q[lo:lo + 512]
            best = _best(some @ x.T, firsts, TOP + 1)
            exact = np.einsum("qkd,qd->qk", x[best], some)     # does not depend on the block's shape
            out += zip(keys[best].tolist(), firsts[best].tolist(), exact.tolist())
        return pd.DataFrame({"q": group["key"][asks].to_numpy(), "keys": [x[0] for x in out],
                             "firsts": [x[1] for x in out], "scores": [x[2] for x in out]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys, firsts, scores = (np.concatenate(group[c].to_list()) for c in ("keys", "firsts", "scores"))
        _, once = np.unique(keys, return_index=True)
        best = once[np.lexsort((firsts[once], -scores[once]))[:TOP + 1]]
        return pd.DataFrame({"q": group["q"].iloc[:1], "keys": [keys[best].tolist()],
                             "firsts": [firsts[best].tolist()], "scores": [scores[best].tolist()]})

    found = meet.groupBy("curve", "block", "part").applyInPandas(score, _FOUND).groupBy("q").applyInPandas(merge, _FOUND)
    near = found.select("q", F.explode(F.arrays_zip("keys", "scores")).alias("x")).select(
        "q", F.col("x.keys").alias("key"), F.col("x.scores").alias("score"))
    near = near.join(one.select("key", "ids"), "key").groupBy("q").agg(F.sort_array(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("id")))))).alias("near"))
    near = queries.join(near, queries["key"] == near["q"]).select("query_id", F.posexplode(F.slice(F.filter(
        "near", lambda x: x["id"] != F.col("query_id")), 1, TOP)).alias("k", "x"))
    return near.select("query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                       (-F.col("x.less")).alias("score"))
