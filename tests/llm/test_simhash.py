import random
import re

import numpy as np
import pytest
import xxhash

from trestle.llm import simhash as S
from trestle.llm.common import table

from .conftest import table_of


def plain(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), 42) for i in range(max(len(words) - size + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(nodes, distance=4):
    """Component of each fingerprint, as its smallest member, by all pairs."""
    nodes = np.array(sorted(set(nodes)), np.uint64)
    label = np.arange(len(nodes))
    for i in range(len(nodes)):
        for j in np.flatnonzero(np.bitwise_count(nodes ^ nodes[i]) <= distance):
            label[label == max(label[i], label[j])] = min(label[i], label[j])
    return {int(x): int(nodes[k]) for x, k in zip(nodes, label)}


def expected(rows):
    prints = [(i, plain(t)) for i, t in rows]
    of = smallest([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    return sorted(((i, f"{p:016x}", least.get(of[p])) for i, p in prints), key=str)


def test_query_against_all_pairs(code):
    from trestle.llm.queries import QUERIES

    rows = [tuple(r) for r in table(code, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    got = QUERIES["op12_simhash_near_dedup"](code, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, S.groups(odd_docs).collect()), key=str) == expected(rows)
    assert S.groups(no_docs).count() == 0
    assert all(len(v) for v in table_of(S.groups(odd_docs)).values())


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "bb", "É", "Ccc", "d."], k=300))
    for at_once in (1, 5, 296, 297, 1000):
        monkeypatch.setattr(S, "AT_ONCE", at_once)
        assert S.fingerprint(text) == plain(text)


def test_blocks_share_one_whenever_bits_are_near():
    rng = random.Random(3)
    for mask in (0, S.blocks(0)[2], S.blocks(S.blocks(0)[1])[4]):
        parts = S.blocks(mask)
        assert sum(p ^ mask for p in parts) == (1 << 64) - 1 ^ mask
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for k in rng.sample([k for k in range(64) if not mask >> k & 1], 4):
                b ^= 1 << k
            assert any(a & p == b & p for p in parts)


@pytest.mark.parametrize("depth", [1, 2])
def test_crowded_places(code, depth):
    """Dense clusters and chains in places far above the region: divided, then group against group."""
    rng = random.Random(depth)
    nodes = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(nodes)[:3]:
        for _ in range(120):
            x = centre
            for k in rng.sample(range(64), rng.randrange(1, 12)):
                x ^= 1 << k
            nodes.add(x)
    chain = 0
    for k in range(0, 60, 4):
        chain |= 0xF << k
        nodes.add(chain)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in nodes]
    links = S.near_pairs(code.createDataFrame(signed, "node long"), region=8, depth=depth).collect()
    label = {x: x for x in nodes}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        label[max(root(a), root(b))] = min(root(a), root(b))
    assert {x: root(x) for x in nodes} == smallest(nodes)
