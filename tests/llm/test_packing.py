import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from trestle.llm import packing
from trestle.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_fullest_against_all_combinations():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 25): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 60)
        got = packing.fullest(counts, room)
        assert all(n <= counts[x] for x, n in got.items())
        best = max(t for c in itertools.product(*[range(n + 1) for n in counts.values()])
                   if (t := sum(a * b for a, b in zip(c, counts))) <= room)
        assert sum(x * n for x, n in got.items()) == best


def test_plan_uses_every_item_once():
    rng = random.Random(2)
    counts = {x: rng.randint(1, 900) for x in rng.sample(range(1, 900), 300)}
    used = dict.fromkeys(counts, 0)
    sequences = 0
    for chosen, times in packing.plan(counts):
        assert sum(x * n for x, n in chosen.items()) <= 2048 and times > 0
        sequences += times
        for x, n in chosen.items():
            used[x] += n * times
    assert used == counts
    assert sequences <= 1.001 * sum(x * n for x, n in counts.items()) / 2048 + 1


def check_places(rows, size=2048):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def check_pieces(rows, texts, size=2048):
    t = Tokenizer.from_file(PATH)
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    assert own.keys() == texts.keys()
    for doc, text in texts.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(own[doc], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert len(parts) == -(-len(ids) // size) and all(p["length"] == size for p in parts[1:])
        at = 0
        for p in parts:
            assert p["start"] == at
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"]:at].tobytes())
        assert at == len(ids)


def test_query_against_the_library(code):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in code.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_best_fit_packing"](code, sf).collect()
    check_pieces(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert check_places(rows) <= -(-tokens // 2048) + 1


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs.filter("doc_id IS NULL OR doc_id <> 5"), PATH).collect()
    check_places(rows)
    check_pieces(rows, {(i if i != 3 else None): t for i, t in enumerate(ODD_TEXTS) if i != 5})
    twice = packing.pack_documents(odd_docs.filter("doc_id = 5"), PATH).collect()
    assert len(twice) == 2 and check_places(twice) == 1
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_one_length_for_all(code):
    docs = code.createDataFrame([(i, "same text") for i in range(3000)], "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, size=16).collect()
    n = rows[0]["length"]
    assert len(rows) == 3000 and check_places(rows, 16) == -(-3000 // (16 // n))
