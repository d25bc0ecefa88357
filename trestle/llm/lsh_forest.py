"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

A document's set holds the hashes of its distinct word shingles.  Documents with equal sets are one class from the
start, so exact copies are never compared.  A class has a MinHash signature; each of ``TREES`` trees orders the classes
by ``DEPTH`` values of it.  In the sorted order of a tree, a region is a run of classes with the same first ``LEAST``
values, and is whole in one task.  Runs that are larger than ``REGION`` are dealt over tasks and divided by one more
value at a time, so the depth follows how crowded a region is.

The classes of a region are candidates for each other.  The full sets come with them, and the sizes of all
intersections of one class with the region are counted at once over the region's shingles; only links that reach the
threshold leave the task, at most one per class that was not connected before.  The first few trees link most groups;
in the others only regions that still hold different components are looked at.  So what is moved and made grows with
the number of classes, not with the square of a group.

Heads that are larger than a region lose pairs at their divisions.  Where such a head still holds different components
after all trees, its classes are joined exactly: two sets that reach the threshold share one of their rarest shingles,
at places that their sizes bound (``pairs``).  Pairs of different components that do are compared on their full sets.
So the links do not depend on the number of tasks or on how large a region may be.

Sets are compared by 64-bit shingle hashes, and equal sets are found by a 128-bit hash of the whole set.  A text is
looked up again by its id and its MD5, so rows that share an id, or have none, are as good as any others.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; texts with fewer words than
a shingle have one shingle, the whole sequence; repeated rows are one class; an id that is null takes part in links but
never names a component (a component without an id has none); other columns are ignored by ``groups`` and passed through
by ``keep``; an empty table gives an empty table.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import land, map_batches, shuffle_width, texts
from trestle.llm.components import components

TREES, DEPTH, LEAST = 16, 8, 4
FIRST_TREES = 4      # looked at whole; the others follow, for what is not yet linked
VALUES = TREES * DEPTH
REGION, REGION_BYTES = 2048, 48 << 20
SAMPLE, COMMON = 4 << 20, 100_000   # shingles that are counted to find the common ones; they only set an order
SALT_ROWS = 1024     # rows of one shingle that one salt meets
HUBS = 8             # rows of a region that are compared with all others before its main component is named
MAX_WORDS = 100_000  # a worker's table of word hashes; a full table is emptied

_rng = np.random.default_rng(1729)
_MULTIPLY = _rng.integers(0, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, VALUES, np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles.  Only A-Z are folded; words end at ASCII white space."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - size + 1, 1)
    out = h[:n].copy()
    for k in range(1, min(size, len(h))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of every hash function.

    The smallest of many values is small, so its leading bits say little; it is mixed before it is shortened.
    """
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(found), 1024):
        part = found[None, lo:lo + 1024] * _MULTIPLY[:, None]
        part += _ADD[:, None]
        np.minimum(least, part.min(1), out=least)
    return (_mix(least) >> np.uint64(48)).astype(">u2")


def name_of(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two longs."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(found.tobytes()))


def profiles(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, digest, n_shingles, x, y, signature`` (name and signature null for empty sets; two longs per tree)."""
    def run(batches):
        for b in batches:
            out = {c: [] for c in ("n_shingles", "x", "y", "signature")}
            for text in b.column(1).to_pylist():
                found = shingles(text, size)
                x, y = name_of(found) if len(found) else (None, None)
                out["n_shingles"].append(len(found))
                out["x"].append(x)
                out["y"].append(y)
                out["signature"].append(signature(found).view(">i8").astype("<i8") if len(found) else None)
            yield {"doc_id": b.column(0), "digest": b.column(2), **out}

    return map_batches(docs.select("doc_id", "text", "digest"), run,
                       "doc_id long, digest string, n_shingles long, x long, y long, signature array<long>")


@dataclass
class _Run:
    """Consecutive rows with the same tree and head."""

    tail: np.ndarray
    node: np.ndarray
    comp: np.ndarray
    sets: list[np.ndarray]

    def part(self, lo: int, hi: int) -> _Run:
        return _Run(self.tail[lo:hi], self.node[lo:hi], self.comp[lo:hi], self.sets[lo:hi])


def _runs(batches: Iterator[pa.RecordBatch], region: int, region_bytes: int) -> Iterator[_Run]:
    """A run that outgrows ``2 * region`` rows or ``region_bytes`` comes in parts that share one row."""
    plain, sets, size = [], [], 0

    def run():
        tail, node, comp = np.array([x[2:] for x in plain], np.int64).T
        return _Run(tail, node, comp, sets)

    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in range(5)), b.column(5)):
            found = np.frombuffer(row[5].as_buffer(), np.uint64).copy()
            if plain and plain[-1][:2] != row[:2]:
                if len(plain) > 1:
                    yield run()
                plain, sets, size = [], [], 0
            plain.append(row[:5])
            sets.append(found)
            size += found.nbytes
            if len(plain) > 1 and (len(plain) >= 2 * region or size > region_bytes):
                yield run()
                plain, sets, size = plain[-1:], sets[-1:], found.nbytes
    if len(plain) > 1:
        yield run()


def _regions(tail: np.ndarray, lo: int, hi: int, depth: int, region: int = REGION) -> Iterator[tuple[int, int]]:
    """Divide a sorted run until its parts are small."""
    if hi - lo <= region or depth == DEPTH:
        for k in range(lo, hi, region):
            yield k, min(k + region, hi)
        return
    value = tail[lo:hi] >> np.int64(16 * (DEPTH - 1 - depth))
    cuts = [lo, *(np.flatnonzero(value[1:] != value[:-1]) + 1 + lo), hi]
    for a, b in zip(cuts, cuts[1:]):
        yield from _regions(tail, a, b, depth + 1, region)


def region_links(run: _Run, threshold: int) -> Iterator[tuple[int, int]]:
    """Links that connect the components of a region as far as its full sets reach the threshold."""
    _, label = np.unique(run.comp, return_inverse=True)
    n = label.max() + 1
    if n < 2:
        return
    rows = len(run.sets)
    size = np.array([len(x) for x in run.sets])
    _, word = np.unique(np.concatenate(run.sets), return_inverse=True)     # numbers of the region's shingles
    owner = np.repeat(np.arange(rows), size)[np.argsort(word, kind="stable")]
    count = np.bincount(word)
    first = np.cumsum(count) - count
    border = np.cumsum(size) - size

    def like(i: int) -> np.ndarray:
        """Rows whose set reaches the threshold with that of row ``i``."""
        own = word[border[i]:border[i] + size[i]]
        c = count[own]
        at = np.repeat(first[own] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        both = np.bincount(owner[at], minlength=rows)
        return np.flatnonzero(100 * both >= threshold * (size[i] + size - both))

    main = None
    for k, i in enumerate(np.argsort(run.node, kind="stable")):
        if k == HUBS:
            main = np.flatnonzero(label == np.bincount(label).argmax())[0]
        if main is not None and label[i] == label[main]:
            continue        # its pairs with rows outside this component are seen from those rows
        for j in like(i):
            if label[j] != label[i]:
                yield tuple(sorted((int(run.node[i]), int(run.node[j]))))
                label[label == label[j]] = label[i]
                n -= 1
        if n == 1:
            return


def links(rows: DataFrame, threshold: int) -> DataFrame:
    """``a, b`` from ``tree, head, tail, node, comp, found, large``.

    A head that fits a region is whole in one task, however many tasks there are; large heads are dealt by range.
    """
    order, width = ["tree", "head", "tail", "node"], shuffle_width(rows.sparkSession)
    region, region_bytes = REGION, REGION_BYTES

    def run(batches):
        for r in _runs(batches, region, region_bytes):
            out = [pair for lo, hi in _regions(r.tail, 0, len(r.node), LEAST, region)
                   for pair in region_links(r.part(max(lo - 1, 0), hi), threshold)]   # with the neighbour before it
            if out:
                yield dict(zip("ab", zip(*out)))

    def linked(part):
        return map_batches(part.drop("large").sortWithinPartitions(*order), run, "a long, b long")

    whole = linked(rows.filter("NOT large").repartition(width, "tree", "head"))
    return whole.union(linked(rows.filter("large").repartitionByRange(width, *order))).distinct()


def _common(sets: DataFrame) -> np.ndarray:
    """The shingles that are frequent in a sample of ``found``, the rarest of them first."""
    total = sets.agg(F.sum(F.length("found"))).first()[0] or 0
    sample = sets.filter(F.pmod(F.xxhash64("node"), F.lit(total // 8 // SAMPLE + 1)) == 0).select("found")

    def run(batches):
        for b in batches:
            for found in b.column(0):
                yield {"word": np.frombuffer(found.as_buffer(), np.int64)}

    rows = map_batches(sample, run, "word long").groupBy("word").count().filter("count > 1")
    rows = rows.orderBy(F.desc("count"), "word").limit(COMMON).collect()
    return np.array([r["word"] for r in reversed(rows)], np.int64)


def _rarest(sets: DataFrame, threshold: int) -> DataFrame:
    """``word, place, size, node, comp``: the first shingles of each set, rare ones first.

    The order is the same for all sets, so two sets that reach the threshold meet in these.
    """
    common = _common(sets)
    at = np.argsort(common)
    key, rank_of = np.append(common[at], np.iinfo(np.int64).max), np.append(at + 1, 0)

    def run(batches):
        for b in batches:
            out = []
            for node, comp, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = np.frombuffer(found.as_buffer(), np.int64)
                k = np.searchsorted(key, words)
                rank = np.where(key[k] == words, rank_of[k], 0)
                n = len(words)
                words = words[np.lexsort((words, rank))][:n + 1 - (threshold * n + 99) // 100]
                out.append((words, np.arange(len(words)), *(np.full(len(words), x, np.int64) for x in (n, node, comp))))
            if out:
                yield dict(zip(("word", "place", "size", "node", "comp"), map(np.concatenate, zip(*out))))

    return map_batches(sets.select("node", "comp", "found"), run,
                       "word long, place long, size long, node long, comp long")


def pairs(sets: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: every pair of ``node, comp, found`` that can reach the threshold and is of different components.

    ``need`` shingles must be common.  The first one in the order has no common one before it, so in each set at least
    ``need`` places are left from it on; otherwise the pair falls out here.
    """
    words = land(_rarest(sets, threshold))
    mixed = words.groupBy("word").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n"))
    mixed = mixed.filter("x < y").select("word", (F.floor(F.col("n") / SALT_ROWS) + 1).alias("salts"))
    words = land(words.join(mixed, "word"))

    def need(both: str) -> str:
        return f"(({threshold} * ({both}) + {99 + threshold}) div {100 + threshold})"

    large = words.withColumn("salt", F.pmod(F.hash("node"), "salts")).drop("salts").alias("l")
    small = words.filter(f"place <= size - {need('size + size')}").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts").alias("s")
    enough = need("l.size + s.size")
    meet = large.join(small, F.expr(
        f"l.word = s.word AND l.salt = s.salt AND l.comp != s.comp"
        f" AND (s.size < l.size OR s.size = l.size AND s.node < l.node)"
        f" AND l.place <= l.size - {enough} AND s.place <= s.size - {enough}"))
    return meet.select(F.col("s.node").alias("a"), F.col("l.node").alias("b")).distinct()


def exact_links(sets: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: the pairs of different components in ``node, comp, found`` that reach the threshold."""
    near = land(pairs(sets, threshold))
    rows = near.join(sets.select(F.col("node").alias("a"), F.col("found").alias("found_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("found").alias("found_b")), "b")

    def run(batches):
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= threshold * (len(x) + len(y) - both):
                    out.append((a, b))
            if out:
                yield dict(zip("ab", zip(*out)))

    return map_batches(rows.select("a", "b", "found_a", "found_b"), run, "a long, b long")


def _whole_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, found``: the full sets of the classes in ``wanted`` (``node, x, y, rep``), from the text of each one's
    representative."""
    wanted = wanted.select("node", "x", "y", F.col("rep.doc_id").alias("_id"), F.col("rep.digest").alias("_digest"))
    rows = docs.join(wanted, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    def run(batches):
        for b in batches:
            out = {"node": [], "found": []}
            for text, *name, node in zip(*(b.column(k).to_pylist() for k in range(4))):
                found = shingles(text, size)
                if len(found) and name_of(found) == tuple(name):
                    out["node"].append(node)
                    out["found"].append(found.tobytes())
            yield out

    return map_batches(rows.select("text", "x", "y", "node"), run, "node long, found binary").dropDuplicates(["node"])


def _with_digest(docs: DataFrame) -> DataFrame:
    return docs.withColumn("digest", F.md5(F.col("text").cast("binary")))


def _labelled(docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """``doc_id, digest, n_shingles, rep`` per row of ``doc_id, text, digest``: ``rep`` is the representative of the
    row's component, its smallest id (no id comes last), then its smallest digest."""
    rows = land(profiles(docs, size))
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    classes = land(rows.filter("x IS NOT NULL").groupBy("x", "y").agg(
        F.min(rep).alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"),
    ).withColumn("node", F.monotonically_increasing_id()))

    heads = classes.select("node", "n_shingles", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)),
                                                            lambda t: F.col("signature")[2 * t])).alias("tree", "head"))
    large = (F.count("*") > REGION) | (F.sum("n_shingles") * 8 > REGION_BYTES)
    crowded = heads.groupBy("tree", "head").agg(F.min("node").alias("x"), F.max("node").alias("y"),
                                                large.alias("large")).filter("x < y")
    keys = land(heads.drop("n_shingles").join(crowded.select("tree", "head", "large"), ["tree", "head"]))
    near = land(classes.join(keys.select("node").distinct(), "node"))
    near = land(near.select("node", "signature").join(_whole_sets(docs, near, size), "node"))

    def forest(now, comp):
        return now.join(near, "node").select(
            "tree", "head", F.element_at("signature", 2 * F.col("tree") + 2).alias("tail"), "node",
            comp.alias("comp"), "found", "large")

    found = land(links(forest(keys.filter(F.col("tree") < FIRST_TREES), F.col("node")), threshold))
    own = keys.filter(F.col("tree") >= FIRST_TREES).join(components(found), "node", "left").withColumn(
        "comp", F.coalesce("root", "node"))
    mixed = own.groupBy("tree", "head").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
    own = own.select("tree", "head", "node", "comp", "large").join(mixed.select("tree", "head"), ["tree", "head"])
    found = land(found.union(links(forest(own, F.col("comp")), threshold)))
    labels = components(found)
    divided = keys.filter("large").select("tree", "head", "node")
    if not divided.isEmpty():
        divided = divided.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node"))
        divided = land(divided.select("tree", "head", "node", "comp"))
        mixed = divided.groupBy("tree", "head").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
        rest = divided.join(mixed.select("tree", "head"), ["tree", "head"]).select("node", "comp").distinct()
        rest = land(near.select("node", "found").join(rest, "node"))
        labels = components(land(found.union(exact_links(rest, threshold))))

    # The representative of each component, for the classes that have links; other classes are components.
    linked = classes.join(labels, "node")
    least = linked.groupBy("root").agg(F.min("rep").alias("least"))
    linked = linked.select("node", "root").join(least, "root").select("node", "least")
    of_class = classes.select("node", "x", "y", "rep").join(linked, "node", "left").select(
        "x", "y", F.coalesce("least", "rep").alias("rep"))
    full = rows.filter("x IS NOT NULL").join(of_class, ["x", "y"]).select("doc_id", "digest", "n_shingles", "rep")
    return full.union(rows.filter("x IS NULL").select("doc_id", "digest", "n_shingles", rep.alias("rep")))


def groups(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    rows = _labelled(_with_digest(texts(docs, id_col, text_col)), size, threshold)
    return rows.select("doc_id", "n_shingles", F.col("rep.doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def keep(docs: DataFrame, size: int = 5, threshold: int = 80, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the one of the smallest id (no id comes last).

    A document is an id and a text.  Of different texts with the smallest id the one of the smallest MD5 stays; of rows
    with the same id and text the one whose columns have the smallest hash.
    """
    rows = _labelled(_with_digest(texts(docs, id_col, text_col)), size, threshold)
    stay = rows.filter(F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("digest") == F.col("rep.digest")))
    stay = land(stay.groupBy(F.col("doc_id").alias("_trestle_id"), F.col("digest").alias("_trestle_digest")).agg(
        F.count("*").alias("_trestle_rows")))
    own = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    found = docs.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col("_trestle_id"))
                      & (own == F.col("_trestle_digest")))
    once = found.filter("_trestle_rows = 1").select(docs.columns)
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = found.filter("_trestle_rows > 1").groupBy("_trestle_id", "_trestle_digest").agg(
        F.min_by(every, F.xxhash64(F.to_json(every))).alias("row"))
    return once.unionByName(again.select("row.*"))
