"""URL rules in a sorted array of 64-bit digests.

A rule is a host and a path prefix, written as one string (``org/``, ``example.org/es/``), with a verdict.  The index
is the array of the rules' xxhash digests in ascending order with the full strings beside it.  A URL gives one probe
for every domain its host lies in and every path prefix length that some rule has; all probes of a batch are found by
one vectorised binary search in the memory-mapped array, and a hit counts only if the stored string is the same.  The
longest rule that fits decides.  URLs that no rule fits get the default verdict.

The index is sent to the executors as one broadcast, which is allowed up to ``MAX_INDEX_BYTES``; each worker maps it
from an unlinked file of its own, so nothing stays behind and a lost executor maps it again.  Beyond that size the array
is dealt over tasks by ranges of digests, and the distinct probes go to the range of theirs (``_by_ranges``); each part
is searched in the same way, with the same result.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; rows that repeat are
judged each on its own; of rules with the same string the one with the smaller verdict counts; a rule without ``/``
covers nothing, as every path starts with one; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import string
import tempfile
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import map_batches, shuffle_width

MAX_INDEX_BYTES = 256 << 20
SEED = 42      # of Spark's own xxhash64, so that both sides compute the same digests


@dataclass
class Index:
    """The rules in ascending order of their digests: digests, strings one after another, their borders, verdicts."""

    digests: bytes
    strings: bytes
    borders: bytes
    verdicts: list[str]
    path_lengths: list[int]
    _maps: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_maps": {}}

    def array(self, name: str, kind: str) -> np.ndarray:
        """One of the arrays, mapped from a file that has no name any more."""
        if name not in self._maps:
            with tempfile.TemporaryFile() as f:
                f.write(getattr(self, name))
                f.flush()
                self._maps[name] = np.memmap(f, dtype=kind, mode="r")
        return self._maps[name]

    def find(self, probes: list[bytes]) -> np.ndarray:
        """Number of the rule that is equal to each probe, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not self.verdicts or not probes:
            return out
        digests, borders, text = self.array("digests", "<i8"), self.array("borders", "<i8"), self.array("strings", "u1")
        wanted = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in probes), np.uint64, len(probes)).view(np.int64)
        lo, hi = np.searchsorted(digests, wanted, "left"), np.searchsorted(digests, wanted, "right")
        for i in np.flatnonzero(lo < hi):
            for k in range(lo[i], hi[i]):            # more than one only where digests collide
                if text[borders[k]:borders[k + 1]].tobytes() == probes[i]:
                    out[i] = k
                    break
        return out


def index_of(rules: list[tuple[int, str, str]]) -> Index:
    """The array of ``digest, rule, verdict`` in ascending order of the digests."""
    strings = [rule.encode() for _, rule, _ in rules]
    return Index(np.array([digest for digest, _, _ in rules], "<i8").tobytes(), b"".join(strings),
                 np.cumsum([0, *map(len, strings)], dtype="<i8").tobytes(), [verdict for _, _, verdict in rules],
                 sorted({len(s) - s.index(b"/") for s in strings if b"/" in s}))


def build_index(rules: DataFrame) -> Index:
    """The sorted array for rows of ``rule, verdict`` with distinct rules."""
    got = rules.select(F.xxhash64("rule").alias("digest"), "rule", "verdict").orderBy("digest", "rule").collect()
    return index_of([tuple(r) for r in got])


def _probes(host: str, path: str, path_lengths: list[int]) -> list[bytes]:
    """Every rule string that would fit: domains from the whole host upwards, prefixes of the path."""
    labels, own = host.split("."), path.encode()
    starts = [own[:n] for n in path_lengths if n <= len(own)]
    return [".".join(labels[k:]).encode() + s for k in range(len(labels)) for s in starts]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` by ``rules`` (``rule, verdict``)."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col).cast("string")).alias("host"),
                        path_of(F.col(url_col).cast("string")).alias("path"))
    rules = (rules.select(F.col("rule").cast("string"), F.col("verdict").cast("string")).filter("rule IS NOT NULL")
             .groupBy("rule").agg(F.min("verdict").alias("verdict")))
    size = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + 32), F.lit(0))).first()[0]
    if size <= max_index_bytes:
        return _by_array(rows, rules, default)
    return _by_ranges(rows, rules, default, bits=int(size // max(max_index_bytes // 4, 1)).bit_length())


def _by_array(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    index = rows.sparkSession.sparkContext.broadcast(build_index(rules))

    def run(batches):
        ix = index.value
        borders = np.frombuffer(ix.borders, "<i8")
        for b in batches:
            probes, owner = [], []
            for i, (host, path) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                own = _probes(host, path, ix.path_lengths)
                probes += own
                owner += [i] * len(own)
            rule, verdict = [None] * b.num_rows, [default] * b.num_rows
            found = ix.find(probes)
            for k in np.flatnonzero(found >= 0):
                i, r = owner[k], found[k]
                text = ix.strings[borders[r]:borders[r + 1]].decode()
                if rule[i] is None or (len(text), text) > (len(rule[i]), rule[i]):
                    rule[i], verdict[i] = text, ix.verdicts[r]
            yield {"page_id": b.column(0), "host": b.column(1), "path": b.column(2), "rule": rule, "verdict": verdict}

    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(rows, run, f"page_id {kind}, host string, path string, rule string, verdict string")


def _by_ranges(rows: DataFrame, rules: DataFrame, default: str, bits: int) -> DataFrame:
    """The same for rule lists beyond the bound of a broadcast: the sorted array is dealt by ranges of digests (their
    leading ``bits``), and every probe goes to the part that its digest falls into.

    A task reads a part's rules first, makes their array, and searches the probes as they come.  Hosts, paths and probes
    are made distinct before they move, so a frequent one is searched once.
    """
    lengths = (rules.filter(F.instr("rule", "/") > 0)
               .select((F.octet_length("rule") - F.octet_length(F.substring_index("rule", "/", 1))).alias("n"))
               .distinct().agg(F.sort_array(F.collect_list("n"))).first()[0])     # at most the longest path's length

    def probes(batches):
        for b in batches:
            hosts, paths, out = [], [], []
            for host, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = [p.decode("utf-8", "ignore") for p in _probes(host, path, lengths)]
                hosts += [host] * len(own)
                paths += [path] * len(own)
                out += own
            yield {"host": hosts, "path": paths, "probe": out}

    def search(batches):
        part, index, held = None, None, []
        for b in batches:
            at, kind, digest, text, verdict = (b.column(k).to_pylist() for k in range(5))
            lo = 0
            found = {"rule": [], "verdict": []}
            while lo < b.num_rows:
                if at[lo] != part:
                    part, index, held = at[lo], None, []
                hi = lo
                while hi < b.num_rows and (at[hi], kind[hi]) == (part, kind[lo]):
                    hi += 1
                if kind[lo] == 0:
                    held += zip(digest[lo:hi], text[lo:hi], verdict[lo:hi])
                elif held:
                    index = index or index_of(held)
                    for k in index.find([t.encode() for t in text[lo:hi]]):
                        if k >= 0:
                            found["rule"].append(held[k][1])
                            found["verdict"].append(held[k][2])
                lo = hi
            yield found

    targets = map_batches(rows.select("host", "path").distinct(), probes, "host string, path string, probe string")
    asked = targets.select("probe").distinct().select(F.lit(1).alias("kind"), F.xxhash64("probe").alias("digest"),
                                                    F.col("probe").alias("text"), F.lit(None).cast("string").alias("verdict"))
    known = rules.select(F.lit(0).alias("kind"), F.xxhash64("rule").alias("digest"), F.col("rule").alias("text"), "verdict")
    dealt = known.union(asked).select(F.shiftrightunsigned("digest", 64 - bits).alias("part"), "*").repartition(
        shuffle_width(rows.sparkSession), "part").sortWithinPartitions("part", "kind", "digest", "text")
    hits = map_batches(dealt, search, "rule string, verdict string")
    best = targets.join(hits, F.col("probe") == F.col("rule")).groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
