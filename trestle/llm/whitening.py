"""Whitening of embeddings along the leading eigenvectors of their covariance, found by spectrum slicing.

Entries become integers (``floor(64 c) + 1000000``), so counts, sums and deviations are exact and do not depend on the
order of work.  Every distinct integer vector counts once.  Tasks read the landed distinct vectors three times: for the
exact sums, for the centred second moments (one matrix per task, added up by Spark), and for the covariance of the
result, which is the proof that the whitening works.  Only sums of d and d x d numbers reach the driver.

The driver finds eigenpairs of the d x d covariance.  The number of eigenvalues above a shift is the number of positive
pivots of an LDL' factorisation of the shifted matrix (its inertia); bisection by such counts encloses each leading
eigenvalue by itself.  Rayleigh quotient iteration from inside the enclosure converges cubically; a quotient that leaves
the enclosure halves it first.  Counts on both sides of the result, one residual apart, certify its number.
Eigenvalues that no shift tells apart share an enclosure, and their vectors are an orthonormal basis.

Defined cases: vectors that are null, empty or hold null or non-finite entries take no part, nor do those with entries
beyond 2^44 (they have no exact product) or of a length other than the most frequent one (of the lengths that are
equally frequent, the longest); repeated rows are returned each, and counted once; a null id stays null; components
whose eigenvalue is zero but for rounding can't be scaled to one and are left out, so a table with one distinct vector
gives no rows; a deviation beyond a long is null; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import land, map_batches

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 44)
AT_ONCE = 4096       # vectors whose moments are multiplied together
_ALPHA = (1 + 17 ** 0.5) / 8      # from this part of the largest entry on, a diagonal entry is a stable pivot


def inertia(a: np.ndarray) -> tuple[int, int]:
    """Number of positive and of negative pivots of the LDL' factorisation of a symmetric matrix, with pivots of one
    or two rows chosen over the whole rest, so that growth stays bounded."""
    a = np.array(a, np.float64)
    plus = minus = 0
    while len(a):
        size = np.abs(a)
        d = int(size.diagonal().argmax())
        i, j = np.unravel_index(size.argmax(), size.shape)
        if size[i, j] == 0:
            break
        if size[d, d] >= _ALPHA * size[i, j]:
            rest = np.arange(len(a)) != d
            plus, minus = plus + (a[d, d] > 0), minus + (a[d, d] < 0)
            column = a[rest, d]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[d, d])
        else:                                   # its determinant is negative: one pivot of either sign
            rest = np.ones(len(a), bool)
            rest[[i, j]] = False
            plus, minus = plus + 1, minus + 1
            columns = a[np.ix_(rest, [i, j])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_([i, j], [i, j])], columns.T)
            a = (a + a.T) / 2
    return int(plus), int(minus)


class Spectrum:
    """Leading eigenpairs of a symmetric matrix, the largest first."""

    def __init__(self, matrix: np.ndarray):
        self.a = np.array(matrix, np.float64)
        self.d = len(self.a)
        self.size = float(np.abs(self.a).sum(1).max()) if self.d else 0.0      # no eigenvalue is larger
        self.tiny = 4 * np.finfo(float).eps * self.size
        self._counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """How many eigenvalues are larger than ``shift``."""
        if shift not in self._counts:
            self._counts[shift] = inertia(self.a - shift * np.eye(self.d))[0]
        return self._counts[shift]

    def enclosure(self, k: int, smallest: float | None = None) -> tuple[float, float]:
        """An interval that holds the ``k``-th eigenvalue and no other, unless it has shrunk to rounding size."""
        known = sorted([*self._counts, -self.size - self.tiny, self.size + self.tiny])
        lo = max(s for s in known if self.above(s) >= k)
        hi = min(s for s in known if s > lo and self.above(s) < k)
        while hi - lo > (smallest or self.tiny) and (
                smallest is not None or self.above(lo) > k or self.above(hi) < k - 1):
            middle = (lo + hi) / 2
            if not lo < middle < hi:
                break
            lo, hi = (middle, hi) if self.above(middle) >= k else (lo, middle)
        return lo, hi

    def pair(self, k: int, found: list[np.ndarray], rng) -> tuple[float, np.ndarray]:
        """The ``k``-th eigenvalue and a unit vector, orthogonal to ``found``."""
        basis = np.array(found).reshape(-1, self.d)

        def unit(v):
            for _ in range(2):
                v = v - basis.T @ (basis @ v)
            return v / np.linalg.norm(v)

        def solved(shift, v):
            for nudge in (0.0, 1.0, 3.0):
                try:
                    got = np.linalg.solve(self.a - (shift + nudge * self.tiny) * np.eye(self.d), v)
                except np.linalg.LinAlgError:
                    continue
                if np.isfinite(got).all() and got.any():
                    return unit(got)
            return v

        lo, hi = self.enclosure(k)
        best = (np.inf, 0.0, None)
        for _ in range(60):
            v = unit(rng.normal(size=self.d))
            for _ in range(2):
                v = solved((lo + hi) / 2, v)            # turns the start towards the enclosed eigenvalue
            for _ in range(12):
                quotient = float(v @ self.a @ v)
                residual = float(np.linalg.norm(self.a @ v - quotient * v))
                if lo - self.tiny <= quotient <= hi + self.tiny and residual < best[0]:
                    best = (residual, quotient, v)
                elif best[2] is not None:
                    break                               # as near as rounding lets it come
                if not lo <= quotient <= hi:
                    break
                v = solved(quotient, v)
            if best[2] is not None and best[0] <= 64 * self.tiny:
                break
            if hi - lo <= self.tiny:
                if best[2] is not None:
                    break
                continue
            lo, hi = self.enclosure(k, smallest=(hi - lo) / 2)
        residual, value, v = best
        margin = max(residual, self.tiny) * 4
        # An eigenvalue is within a residual of the quotient: counts there say that it is the k-th.
        if not self.above(value - margin) >= k > self.above(value + margin):
            raise ArithmeticError(f"eigenvalue {k} can't be numbered")
        return value, v

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``most`` positive eigenvalues, falling, and their vectors as rows."""
        rng = np.random.default_rng(2027)
        values, vectors = [], []
        zero = max(self.d, 1) * self.tiny
        for k in range(1, min(most, self.d) + 1):
            if self.above(zero) < k:
                break
            value, v = self.pair(k, vectors, rng)
            if value <= zero:
                break
            values.append(value)
            vectors.append(v)
        order = np.argsort(-np.array(values), kind="stable")        # those of one enclosure may come in either order
        return np.array(values)[order], np.array(vectors).reshape(-1, self.d)[order]


@dataclass
class Whitening:
    n: int                    # distinct vectors
    sums: list[int]           # exact, per dimension
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # unit rows
    trace: float
    identity_error: float = 0.0

    def __post_init__(self):
        n = max(self.n, 1)
        self.base = np.array([s // n for s in self.sums], np.int64)      # whole part of the means
        self.over = [s - n * int(b) for s, b in zip(self.sums, self.base)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - np.array(self.over, np.float64) / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S)^2)`` of each row, exact; None beyond a long."""
        y = x - self.base
        largest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if largest ** 2 * x.shape[1] < 1 << 63:
            return ((self.n * y - np.array(self.over, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(c) - o) ** 2 for c, o in zip(row, self.over)) for row in y.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _valid(vector: Column) -> Column:
    return (F.size(vector) > 0) & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (
        F.abs(c.cast("double")) > LARGEST))


def _matrix(batch, at: int, d: int) -> np.ndarray:
    x = batch.column(at)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def _moments(rows: DataFrame, of, length: int, d: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``of(x)`` (``d`` values each, of ``length`` in ``x``); one matrix per
    task goes into the sum."""
    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b, 0, length)
            for lo in range(0, len(x), AT_ONCE):
                y = of(x[lo:lo + AT_ONCE])
                total += y.T @ y
        i, j = np.triu_indices(d)
        yield {"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]}

    sums = map_batches(rows.select("x"), run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for r in sums.collect():                    # d (d + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def vectors_of(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x, d`` of the rows that take part."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.filter(F.coalesce(_valid(F.col("v")), F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.filter(F.size("v") == d).select("vec_id", _integers(F.col("v")).alias("x"), F.lit(d).alias("d"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors in ``x, d``."""
    distinct = land(rows.select("x", "d").distinct())

    def add(batches):
        n, total = 0, None
        for b in batches:
            if b.num_rows:
                x = _matrix(b, 0, b.column(1)[0].as_py())
                n, total = n + len(x), x.sum(0) + (0 if total is None else total)
        if n:
            yield {"i": np.arange(-1, len(total)).astype(np.int32), "s": np.concatenate(([n], total))}

    sums = {r["i"]: int(r["s"]) for r in map_batches(distinct, add, "i int, s long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}              # d + 1 rows
    n, d = sums.pop(-1, 0), len(sums)
    model = Whitening(n, [sums[i] for i in range(d)], np.empty(0), np.empty((0, d)), 0.0)
    if n < 2:
        return model
    covariance = _moments(distinct, model.centred, d, d) / n
    values, vectors = Spectrum(covariance).leading(components)
    model = Whitening(n, model.sums, values, vectors, float(np.trace(covariance)))
    if len(values):
        # The sums are exact, so the whitened vectors have the mean zero but for rounding.
        own = _moments(distinct, model.whitened, d, len(values)) / n
        model.identity_error = float(np.abs(own - np.eye(len(values))).max())
    return model


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector and component."""
    k, d = len(model.values), len(model.sums)

    def run(batches):
        for b in batches:
            x = _matrix(b, 1, d)
            for lo in range(0, len(x) if k else 0, AT_ONCE):
                part = x[lo:lo + AT_ONCE]
                m = len(part)
                yield {"vec_id": b.column(0).slice(lo, m).take(pa.array(np.repeat(np.arange(m), k))),
                       "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                       "n": np.full(m * k, model.n), "deviation": [v for v in model.deviations(part) for _ in range(k)],
                       "whitened": model.whitened(part).reshape(-1),
                       "explained": np.tile(model.values / model.trace, m),
                       "identity_error": np.full(m * k, model.identity_error)}

    return map_batches(rows.select("vec_id", "x"), run, "vec_id long, component int, n long, deviation long, "
                                                         "whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that takes part."""
    rows = vectors_of(embeddings, id_col, vector_col)
    return apply(rows, fit(rows, components))
