"""SimHash near-duplicates: fingerprints that differ in few bits meet in an equal block of bits.

A fingerprint has a bit set where more than half of the hashes of a text's word shingles (repeats included) have it.
Equal fingerprints are one class from the start.  If the 64 bits are cut into ``DISTANCE + 1`` blocks, two fingerprints
that differ in at most ``DISTANCE`` bits agree in one block whole, so classes meet by (block, its value) and their
Hamming distances are counted there.  The same holds for the bits outside that block: a meeting place with more than
``REGION`` classes is divided by cutting its other bits into blocks again, ``DEPTH`` times at most.  No division loses
a pair.

Before a crowded place is divided, its classes are compared in groups of about ``REGION``, which connects most of a
dense cluster; only places that still hold different components are divided.  What is crowded after the last division
is compared group against group, in one task for each two groups.  A task returns only links that connect components
which were separate in it, so what is moved grows with the number of classes, not with their pairs.

Defined cases: null, empty and blank texts have no shingles and the fingerprint zero, which is linked like any other; a
text with fewer words than a shingle has one, the whole sequence; repeated rows are one class; an id that is null takes
part in links but never names a component (a component without an id has none); other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import land, map_batches, shuffle_width, texts
from trestle.llm.components import components

DISTANCE, BITS = 4, 64
REGION = 2048        # classes that are compared in one go
DEPTH = 3            # divisions: 13, then 23, then 31 bits are equal
SEED = 42
AT_ONCE = 1 << 15    # shingles whose bits are counted together


def fingerprint(text: str, size: int = 4) -> int:
    words = text.encode("utf-8", "replace").lower().split()
    n = max(len(words) - size + 1, 1) if words else 0
    total = np.zeros(BITS, np.int64)
    for lo in range(0, n, AT_ONCE):
        part = words[lo:min(lo + AT_ONCE, n) + size - 1]
        joined, ends = b" ".join(part), np.cumsum([len(w) + 1 for w in part])
        starts, shingles = (ends - [len(w) + 1 for w in part]).tolist(), min(AT_ONCE, n - lo)
        stops = (ends[min(size, len(part)) - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:shingles], stops)), "<u8", shingles)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, node`` of ``doc_id, text``; the node is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            found = np.fromiter((fingerprint(t, size) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield {"doc_id": b.column(0), "node": found.view(np.int64)}

    return map_batches(docs, run, "doc_id long, node long")


def blocks(mask: int, distance: int = DISTANCE) -> list[int]:
    """The masks that have one more of the ``distance + 1`` blocks of the bits outside ``mask``."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    cuts = [len(free) * k // (distance + 1) for k in range(distance + 2)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _divided(rows: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """``mask, value, node, comp``: every row at each meeting place below its own."""
    def list_of(mask: int) -> Column:
        return F.array(*[F.lit(_signed(m)).cast("long") for m in blocks(mask, distance)])

    below = reduce(lambda other, m: F.when(F.col("mask") == _signed(m), list_of(m)).otherwise(other), masks[1:],
                   list_of(masks[0]))
    rows = rows.select("node", "comp", F.explode(below).alias("mask"))
    return rows.select("mask", F.col("node").bitwiseAND(F.col("mask")).alias("value"), "node", "comp")


def region_links(node: np.ndarray, comp: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect the components of some classes as far as their fingerprints are near."""
    if comp.min() == comp.max():
        return
    bits = node.view(np.uint64)
    _, label = np.unique(comp, return_inverse=True)
    left = label.max()
    for i in range(len(node)):
        for j in np.flatnonzero((np.bitwise_count(bits ^ bits[i]) <= distance) & (label != label[i])):
            if label[j] != label[i]:
                yield int(node[i]), int(node[j])
                label[label == label[j]] = label[i]
                left -= 1
        if not left:
            return


def links(rows: DataFrame, key: list[str], distance: int) -> DataFrame:
    """``a, b`` from rows that are compared where they have the same ``key``: a bounded number of them."""
    def run(batches):
        last, held = None, []

        def out():
            nodes, comps = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            got = list(region_links(nodes, comps, distance)) if len(nodes) > 1 else []
            return dict(zip("ab", map(list, zip(*got)))) if got else None

        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(b.num_columns)]
            n = b.num_rows
            if not n:
                continue
            new = np.any([c[1:] != c[:-1] for c in cols[:-2]], axis=0)
            borders = [0, *(np.flatnonzero(new) + 1), n]
            for lo, hi in zip(borders, borders[1:]):
                here = tuple(c[lo] for c in cols[:-2])
                if here != last and held:
                    got = out()
                    if got:
                        yield got
                    held = []
                last = here
                held.append((cols[-2][lo:hi], cols[-1][lo:hi]))
        if held:
            got = out()
            if got:
                yield got

    rows = rows.select(*key, "node", "comp").repartition(shuffle_width(rows.sparkSession), *key)
    return map_batches(rows.sortWithinPartitions(*key), run, "a long, b long")


def _groups_of(region: int) -> Column:
    return F.ceil(F.col("n") / F.lit(region)).cast("long")


def near_pairs(nodes: DataFrame, distance: int = DISTANCE, region: int | None = None,
               depth: int | None = None) -> DataFrame:
    """``a, b``: links between the rows of ``node`` that connect whatever pairs of at most ``distance`` bits connect."""
    region, depth = region or REGION, DEPTH if depth is None else depth
    place = ["mask", "value"]
    masks = [0]
    rows = _divided(nodes.select("node", F.col("node").alias("comp"), F.lit(0).cast("long").alias("mask")), masks,
                    distance)
    found = None
    for level in range(1, depth + 1):
        masks = [m for old in masks for m in blocks(old, distance)]
        met = rows.groupBy(*place).agg(F.count("*").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y"))
        met = met.filter("x < y").select(*place, _groups_of(region).alias("groups"))
        rows = land(rows.join(met, place).withColumn("part", F.pmod(F.xxhash64("node"), "groups")))
        new = links(rows, [*place, "part"], distance)
        found = land((new if found is None else found.union(new)).distinct())
        rows = rows.filter("groups > 1")
        if rows.isEmpty():
            return found
        labels = components(found)
        rows = land(rows.drop("comp").join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node"))
                    .drop("root"))
        mixed = rows.groupBy(*place).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y")
        rows = land(rows.join(mixed.select(*place), place))
        if rows.isEmpty():
            return found
        if level < depth:
            rows = _divided(rows, masks, distance).distinct()
    # Group against group, each row once for every group of its place.
    other = F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)
    rows = rows.select(*place, "node", "comp", "part", F.explode(other).alias("other")).select(
        *place, F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "node", "comp")
    return land(found.union(links(rows.filter("one < two"), [*place, "one", "two"], distance)).distinct())


def groups(docs: DataFrame, size: int = 4, distance: int = DISTANCE, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    rows = land(fingerprints(texts(docs, id_col, text_col), size))
    classes = land(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    labels = land(components(near_pairs(classes, distance)))
    least = classes.join(labels, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = labels.join(least, "root").select("node", "component_id", F.lit(True).alias("linked"))
    of_class = classes.join(linked, "node", "left").select(
        "node", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return rows.join(of_class, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
