"""Packing of documents into sequences of a fixed number of tokens by minimum bin slack.

The lengths of all pieces are counted first; there are at most as many different lengths as a sequence has tokens, so
the plan is made from that small histogram, whatever the number of documents.  For each sequence the longest length
left is taken, and a bitset subset-sum over the lengths still available finds the fullest combination that fits
beside it.  The combination is removed as often as the counts allow, which makes one pattern of the plan.  Spark then
numbers the pieces of each length (salted, so a common length is split over tasks) and each piece finds its pattern,
sequence and offset by its number.

Defined cases: a null text counts as empty and has only the end id; an empty table gives an empty table; repeated rows
are packed each on its own; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trestle.llm.common import land, map_batches, shuffle_width, texts
from trestle.llm.tokens import encode_all

SEQUENCE = 2048
END_ID = 0
KNOWN_CHUNKS = 150_000    # entries of a worker's table of known chunks


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text", max_chunks: int = KNOWN_CHUNKS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents with their end id; only longer ones than ``size`` are
    cut, into pieces of ``size`` of which the first may be shorter."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        for b in batches:
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc, ids in zip(b.column(0).to_pylist(), encode_all(tokenizer, b.column(1), max_chunks)):
                ids = ids.tobytes() + end
                n, lo, k = len(ids) // 4, 0, 0
                while lo < n:
                    hi = lo + ((n - lo) % size or size)
                    for c, v in zip(out, (doc, k, lo, hi - lo, zlib.crc32(ids[4 * lo:4 * hi]))):
                        out[c].append(v)
                    lo, k = hi, k + 1
            yield out

    return map_batches(texts(docs, id_col, text_col), run,
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: Mapping[int, int], room: int) -> Counter:
    """The multiset of available lengths with the largest sum within ``room`` (bounded subset-sum on bitsets)."""
    every = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, n in counts.items() if n > 0 and x <= room), reverse=True):
        steps.append((length, reach))
        left, part = min(counts[length], room // length), 1
        while left > 0:      # 1, 2, 4, ... copies at once
            part = min(part, left)
            reach |= (reach << (part * length)) & every
            left, part = left - part, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        while not before >> total & 1:
            total -= length
            chosen[length] += 1
    return chosen


def plan(counts: Mapping[int, int], size: int = SEQUENCE) -> list[tuple[Counter, int]]:
    """``(lengths of one sequence, number of such sequences)`` that use up ``counts``."""
    left, out = dict(counts), []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, size - longest)
        left[longest] += 1
        chosen[longest] += 1
        times = min(left[x] // n for x, n in chosen.items())
        out.append((chosen, times))
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def _slots(patterns: list[tuple[Counter, int]]) -> tuple[np.ndarray, ...]:
    """Sorted (length, first number) of every slot of the plan, with its first sequence and its offset."""
    used, rows, first = Counter(), [], 0
    for chosen, times in patterns:
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                rows.append((length, used[length], first, offset))
                used[length] += times
                offset += length
        first += times
    rows.sort()
    return tuple(np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))


def pack(items: DataFrame, size: int = SEQUENCE, length_col: str = "length", order_by: tuple[str, ...] = ()) -> DataFrame:
    """``items`` (a landed table of rows with a length from 1 to ``size``) with ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    n = F.col(length_col)
    salts = 4 * shuffle_width(spark)
    items = items.withColumn("_salt", F.pmod(F.xxhash64(*(order_by or items.columns)), F.lit(salts)))
    counts = items.groupBy(length_col, "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(length_col).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = land(counts.select(F.col(length_col).alias("_length"), F.col("_salt").alias("_part"), "_n",
                                F.coalesce(before, F.lit(0)).alias("_before")))
    # At most ``size`` rows, whatever the input: the number of different lengths.
    histogram = {r[0]: r[1] for r in counts.groupBy("_length").agg(F.sum("_n")).collect()}
    length, number, sequence, offset = _slots(plan(histogram, size))
    keys = length * (1 << 40) + number

    numbered = (items.withColumn("_k", F.row_number().over(
        Window.partitionBy(length_col, "_salt").orderBy(*(order_by or items.columns))))
        .join(counts, (n == F.col("_length")) & (F.col("_salt") == F.col("_part")))
        .withColumn("_number", F.col("_before") + F.col("_k") - 1))
    kept = [c for c in items.columns if c != "_salt"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name != "_salt")
    at, last = kept.index(length_col), len(kept)

    def run(batches):
        for b in batches:
            own, num = (np.asarray(b.column(k), dtype=np.int64) for k in (at, last))
            k = np.searchsorted(keys, own * (1 << 40) + num, side="right") - 1
            yield {**{c: b.column(i) for i, c in enumerate(kept)},
                   "sequence_id": sequence[k] + num - number[k], "offset": offset[k]}

    return map_batches(numbered.select(*kept, "_number"), run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID,
                   max_chunks: int = KNOWN_CHUNKS) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place.

    ``max_chunks`` bounds each worker's table of known chunks; a smaller one takes less memory and more time.
    """
    cut = land(pieces(docs, tokenizer, size, end_id, max_chunks=max_chunks))
    return pack(cut, size, order_by=("doc_id", "piece", "ids_crc32", "start", "length"))
