"""Token ids in shard files with a minimal perfect hash index from document keys to places.

Writing: documents are range-partitioned by id; each task encodes its documents in order and writes one payload file,
the raw little-endian ids of its documents one after another.  The files have names of their own per attempt; the
table of entries, committed by Spark, names the files of the attempts that count, so a lost executor leaves nothing
but an unused file.

Index: the keys are dealt into groups of about ``GROUP`` by hash.  In each group, keys that fall into the same bucket
search a displacement that puts all of them on free slots, large buckets first; single keys take the slots that are
left.  A slot holds the key's fingerprint, shard, offset and length, so there are as many slots as keys and a key is
found in constant time.  A key that was never stored is told by its fingerprint.

A key is a document id and its number among rows with the same id (0 for the first).  Defined cases: a null text is
empty and has only the end id; a null id is a key of its own that sorts first; an empty table makes a store without
shards; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trestle.llm.common import map_batches, shuffle_width, texts
from trestle.llm.tokens import encode_all
from trestle.session import checkpoint_dir

GROUP = 4096
_ENTRY = "doc_id long, copy int, shard int, file string, offset long, n_tokens long"


@dataclass(frozen=True)
class Store:
    """Folder of a store: ``payload`` (files of raw ids), ``entries`` and ``index`` (Parquet)."""

    root: str
    width: int        # bytes of an id
    groups: int       # of the index


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(key: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64 bits of a key; group, bucket, slots and fingerprint all come from them."""
    return _mix(_mix(key.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + copy.astype(np.uint64))


def _slot(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h + (seed.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(n)).astype(np.int64)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(8)) % np.uint64(n)).astype(np.int64)


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mix(h + np.uint64(0x632BE59BD9B4E019)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def build_seeds(h: np.ndarray) -> np.ndarray:
    """Per bucket: a displacement (>= 0), or -1 - slot for a bucket with one key."""
    n = len(h)
    bucket = _bucket(h, n)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(n + 1))
    size = np.diff(starts)
    seeds, free = np.zeros(n, np.int32), np.ones(n, bool)
    for b in np.argsort(-size, kind="stable"):
        if size[b] < 2:
            break
        own, first = h[order[starts[b]:starts[b + 1]]], 0
        if len(np.unique(own)) < len(own):      # no displacement can part them
            raise ArithmeticError("two keys of the index share all 64 bits of their hash")
        while True:      # 64 displacements at once
            tried = np.arange(first, first + 64)
            slots = _slot(own[None, :], tried[:, None], n)
            slots_sorted = np.sort(slots, axis=1)
            good = free[slots].all(1) & (np.diff(slots_sorted, axis=1) != 0).all(1)
            if good.any():
                k = int(good.argmax())
                seeds[b] = tried[k]
                free[slots[k]] = False
                break
            first += 64
    single = np.flatnonzero(size == 1)
    seeds[single] = -1 - np.flatnonzero(free)[:len(single)]
    return seeds


def find(seeds: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Slots of keys (of any keys: compare the fingerprint)."""
    n = len(seeds)
    seed = seeds[_bucket(h, n)]
    return np.where(seed < 0, -1 - seed.astype(np.int64), _slot(h, np.maximum(seed, 0), n))


def write(docs: DataFrame, tokenizer: str, end_id: int, root: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", width: int = 2) -> Store:
    """Encode all documents into a new store; ``width`` 2 holds ids below 65536, 4 any id."""
    spark = docs.sparkSession
    root = root or f"{checkpoint_dir(spark).rstrip('/')}/llm/store-{uuid.uuid4().hex}"
    kind = {2: "<u2", 4: "<u4"}[width]
    rows = texts(docs, id_col, text_col).repartitionByRange(shuffle_width(spark), "doc_id")

    def run(batches):
        part = TaskContext.get().partitionId()
        name = f"payload/{part:06d}-{uuid.uuid4().hex}.ids"
        out, offset, last, copy = None, 0, "none yet", 0
        for b in batches:
            got = {c: [] for c in ("doc_id", "copy", "shard", "file", "offset", "n_tokens")}
            if out is None:
                store, path = _open(f"{root}/{name}")
                store.create_dir(path.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(path)
            for doc, ids in zip(b.column(0).to_pylist(), encode_all(tokenizer, b.column(1))):
                ids = np.append(ids, np.uint32(end_id))
                if width == 2 and ids.max() > 0xFFFF:
                    raise ValueError("this vocabulary needs width 4")
                out.write(ids.astype(kind).tobytes())
                copy = copy + 1 if doc == last else 0
                last = doc
                for c, v in zip(got, (doc, copy, part, name, offset, len(ids))):
                    got[c].append(v)
                offset += len(ids)
            yield got
        if out is not None:
            out.close()

    map_batches(rows.sortWithinPartitions("doc_id", "text"), run, _ENTRY).write.parquet(f"{root}/entries")
    entries = spark.read.parquet(f"{root}/entries")
    n = entries.count()
    groups = max(1, -(-n // GROUP))

    def index(group: pd.DataFrame) -> pd.DataFrame:
        h = _keys(group)
        seeds = build_seeds(h)
        at = np.argsort(find(seeds, h), kind="stable")
        own = group.iloc[at]
        files, code = np.unique(own["file"], return_inverse=True)
        return pd.DataFrame({
            "group": [int(group["group"].iloc[0])], "seeds": [seeds.tobytes()],
            "prints": [fingerprint(h)[at].tobytes()], "files": [files.tolist()],
            "file_no": [code.astype("<i4").tobytes()], "shard": [own["shard"].to_numpy("<i4").tobytes()],
            "offset": [own["offset"].to_numpy("<i8").tobytes()],
            "n_tokens": [own["n_tokens"].to_numpy("<i8").tobytes()]})

    (_grouped(entries, groups).groupBy("group").applyInPandas(
        index, "group long, seeds binary, prints binary, files array<string>, file_no binary, shard binary, "
               "offset binary, n_tokens binary").write.parquet(f"{root}/index"))
    return Store(root, width, groups)


def _keys(rows: pd.DataFrame) -> np.ndarray:
    return hashes(rows["key"].to_numpy(np.int64), rows["copy"].to_numpy(np.int64) * 2 + rows["is_null"].to_numpy(np.int64))


def _grouped(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` with ``key``, ``is_null`` and ``group``: the part of the index their key belongs to."""
    return rows.withColumns({
        "key": F.coalesce("doc_id", F.lit(0)), "is_null": F.col("doc_id").isNull().cast("int"),
        "group": F.pmod(F.xxhash64("doc_id", "copy"), F.lit(groups)).cast("long")})


def lookup(spark: SparkSession, store: Store, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, shard, file, offset, n_tokens`` of those ``keys`` (``doc_id, copy``) that are in the store."""
    index = spark.read.parquet(f"{store.root}/index")

    def run(rows: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(part):
            return pd.DataFrame({c.split()[0]: pd.Series([], dtype=object) for c in _ENTRY.split(", ")})
        p = part.iloc[0]
        h = _keys(rows)
        at = find(np.frombuffer(p["seeds"], "<i4"), h)
        hit = np.frombuffer(p["prints"], "<u4")[at] == fingerprint(h)
        at = at[hit]
        read = {c: np.frombuffer(p[c], t)[at] for c, t in
                (("file_no", "<i4"), ("shard", "<i4"), ("offset", "<i8"), ("n_tokens", "<i8"))}
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy()[hit], "copy": rows["copy"].to_numpy()[hit], "shard": read["shard"],
            "file": np.asarray(p["files"], dtype=object)[read["file_no"]], "offset": read["offset"],
            "n_tokens": read["n_tokens"]}).astype({"doc_id": "Int64"})

    return (_grouped(keys.select("doc_id", "copy"), store.groups).groupBy("group")
            .cogroup(index.groupBy("group")).applyInPandas(run, _ENTRY))


def read_digests(spark: SparkSession, store: Store, places: DataFrame) -> DataFrame:
    """Read the payload at ``places`` (from :func:`lookup`): ``doc_id, start, n_tokens, ids_crc32``."""
    entries = spark.read.parquet(f"{store.root}/entries")
    shards = entries.groupBy("shard").agg(F.sum("n_tokens").alias("n"))          # one row per file
    base = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select(F.col("shard").alias("_shard"), F.coalesce(base, F.lit(0)).alias("_base"))
    rows = places.join(shards, F.col("shard") == F.col("_shard")).select(
        "doc_id", "file", "offset", "n_tokens", (F.col("_base") + F.col("offset")).alias("start"))
    rows = rows.repartition(shuffle_width(spark), "file").sortWithinPartitions("file", "offset")
    kind, size, root = {2: "<u2", 4: "<u4"}[store.width], store.width, store.root

    def run(batches):
        name, src = None, None
        for b in batches:
            crc = []
            for file, offset, n in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                if file != name:
                    if src is not None:
                        src.close()
                    where, path = _open(f"{root}/{file}")
                    name, src = file, where.open_input_file(path)
                raw = src.read_at(n * size, offset * size)
                crc.append(zlib.crc32(np.frombuffer(raw, kind).astype("<u4").tobytes()))
            yield {"doc_id": b.column(0), "start": b.column(4), "n_tokens": b.column(3), "ids_crc32": crc}
        if src is not None:
            src.close()

    return map_batches(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long")
