import random

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import lsh_forest
from trestle.llm.queries import QUERIES


def word_sets(texts, size):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    return out


def brute(ids, texts, size, threshold=80):
    sets = word_sets(texts, size)
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and find(i) != find(j):
                if 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                    a, b = find(i), find(j)
                    up[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(x, least.get(find(i), x))
    return [len(s) for s in sets], [least[find(i)] for i in range(len(ids))]


def near_copies(seed, groups, members, words=60):
    """Copies with few to many changed words, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(words)]
        for _ in range(members):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 4000)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size,groups,members", [(4, 30, 6), (5, 2, 120)])
def test_components_against_all_pairs(code, size, groups, members):
    texts = near_copies(groups, groups, members)
    ids = list(range(100, 100 + len(texts)))
    docs = code.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = table_of(lsh_forest.groups(docs, size=size))
    n, component = brute(ids, texts, size)
    for i, x in enumerate(ids):
        assert got[x] == [{"doc_id": x, "n_shingles": n[i], "component_id": component[i], "kept": component[i] == x}]


def test_small_sets_at_the_threshold(code):
    texts = ["a b c d e f g h", "a b c d e f g", "A  b\tc d", "a b c d", "a b c", "a b c", "a b", "", None, "a b c d e f g h i j"]
    ids = list(range(len(texts)))
    docs = code.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = table_of(lsh_forest.groups(docs, size=4))
    n, component = brute(ids, texts, 4)
    assert [got[i][0]["n_shingles"] for i in ids] == n
    assert [got[i][0]["component_id"] for i in ids] == component
    assert got[1][0]["component_id"] == 0            # 4 of 5 shingles


def test_odd_rows(odd_docs, no_docs):
    got = table_of(lsh_forest.groups(odd_docs))
    assert [got[i][0]["component_id"] for i in (0, 1, 2)] == [0, 1, 2] and got[0][0]["n_shingles"] == 0
    assert got[12][0]["component_id"] == 6 and not got[12][0]["kept"]
    assert got[None][0]["component_id"] is None and got[None][0]["kept"]
    assert len(got[5]) == 2 and all(r["kept"] for r in got[5])
    assert lsh_forest.groups(no_docs).count() == 0
    kept = lsh_forest.keep(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["line"] for r in kept.collect()) == [i for i in range(len(ODD_TEXTS)) if i != 12]


def test_rows_that_share_an_id_are_documents_of_their_own(code):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(7, "quite another text with words of its own here", 1), (7, long, 2), (3, long + " thirteen", 3), (7, long, 4),
            (None, long, 5), (None, "no id and nothing like the others at all", 6), (None, "no id and nothing like the others at all", 7),
            (8, "", 8), (8, None, 9), (9, " ", 10)]
    docs = code.createDataFrame(rows, "doc_id long, text string, n long")
    kept = sorted(r["n"] for r in lsh_forest.keep(docs, size=4).collect())
    assert [n for n in kept if n not in (6, 7, 8, 9)] == [1, 3, 10]     # one of each group, each unrelated text
    assert len({6, 7} & set(kept)) == 1 and len({8, 9} & set(kept)) == 1     # equal id and text: one row
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in lsh_forest.groups(docs, size=4).collect()}
    assert got[3, 10] == 3 and got[7, 9] == 3 and got[None, 9] == 3 and got[7, 6] == 7 and got[None, 6] is None
    again = sorted(r["n"] for r in lsh_forest.keep(docs.repartition(7), size=4).collect())
    assert again == kept                                                    # also which of the equal rows stays


def test_rows_grow_with_the_table_when_every_id_is_null(code, monkeypatch):
    """Classes meet the texts by id and digest: without ids, no text meets the others' classes."""
    from trestle.llm import common

    def landed(n):
        sizes = []
        with monkeypatch.context() as m:
            m.setattr(lsh_forest, "land", lambda df: sizes.append((out := common.land(df)).count()) or out)
            texts = [t for k in range(n) for t in [f"text {k} " + " ".join(f"w{k}_{i}" for i in range(40))]]
            texts += [t + " end" for t in texts]
            docs = code.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
            got = lsh_forest.groups(docs, size=4)
            sizes.append(got.count())
        return sizes

    few, many = landed(30), landed(120)
    assert len(few) == len(many) and all(b <= 4.5 * max(a, 4) for a, b in zip(few, many))


def test_regions_cover_the_run_and_share_prefixes():
    rng = np.random.default_rng(0)
    tail = np.sort(rng.integers(0, 1 << 63, 20_000))
    tail[3000:9000] = tail[3000]
    tail.sort()
    parts = list(lsh_forest._regions(tail, 0, len(tail), lsh_forest.LEAST))
    assert parts[0][0] == 0 and parts[-1][1] == len(tail)
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert max(b - a for a, b in parts) <= lsh_forest.REGION


def test_few_pairs_over_many_partitions(code, monkeypatch):
    bases = [[f"w{k}_{i}" for i in range(60)] for k in range(3)]
    texts = [" ".join(w) for b in bases for w in (b, b[:2] + ["other"] + b[3:])]      # similarity 0.9
    ids = list(range(len(texts)))
    docs = code.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    monkeypatch.setattr(lsh_forest, "shuffle_width", lambda spark: 64)
    got = table_of(lsh_forest.groups(docs, size=4))
    assert [got[i][0]["component_id"] for i in ids] == brute(ids, texts, 4)[1] == [0, 0, 2, 2, 4, 4]


def template_pairs(pairs):
    """Texts about 0.7 alike, each with one partner at 0.81 (sets of single words)."""
    rng = random.Random(7)
    texts = []
    for k in range(pairs):
        own = [f"o{k}_{i}" for i in range(15)]
        for member in range(2):
            words = [f"t{i}" for i in range(70)] + own[:6 + 9 * (1 - member)] + [f"p{k}_{i}" for i in range(9 * member)]
            rng.shuffle(words)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


def test_divided_regions_have_an_exact_rest(code, monkeypatch):
    texts = template_pairs(200)
    ids = list(range(len(texts)))
    docs = code.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    monkeypatch.setattr(lsh_forest, "REGION", 4)
    got = table_of(lsh_forest.groups(docs, size=1))
    want = brute(ids, texts, 1)[1]
    assert len(set(want)) == 200
    assert [got[i][0]["component_id"] for i in ids] == want


def test_pairs_by_rarest_shingles_against_all_pairs(code, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(lsh_forest, "SALT_ROWS", 3)
    pool = rng.integers(0, 1 << 63, 40, np.uint64)
    sets = [rng.choice(pool, rng.integers(1, 20), replace=False) for _ in range(150)]
    sets = list(map(np.unique, sets + [np.append(x[1:], rng.choice(pool)) for x in sets]))
    rows = [(i, i % 7, x.tobytes()) for i, x in enumerate(sets)]
    got = lsh_forest.exact_links(code.createDataFrame(rows, "node long, comp long, found binary"), 80).collect()
    want = set()
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(x, sets[j]))
            if i % 7 != j % 7 and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                want.add((j, i))
    assert len(want) > 50 and sorted(tuple(sorted((r["a"], r["b"]))) for r in got) == sorted(want)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        both = rng.integers(0, 1 << 63, int(2000 * share)).astype(np.uint64)
        rest = rng.integers(0, 1 << 63, 2000 - len(both)).astype(np.uint64)
        x, y = np.unique(np.concatenate([both, rest[::2]])), np.unique(np.concatenate([both, rest[1::2]]))
        agree = (lsh_forest.signature(x) == lsh_forest.signature(y)).mean()
        assert abs(agree - share) < 4 * (share * (1 - share) / lsh_forest.VALUES) ** 0.5


def test_signatures_of_very_large_sets_differ():
    rng = np.random.default_rng(3)
    x, y = (lsh_forest.signature(rng.integers(0, 1 << 63, 300_000).astype(np.uint64)) for _ in range(2))
    assert len(np.unique(x)) > 120 and (x == y).mean() < 0.05


def test_long_texts_that_outgrow_the_bytes_of_a_region(code, monkeypatch):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 10 ** 9)}" for _ in range(3000)]
        texts += [" ".join(base), " ".join(base[:1500] + ["x"] + base[1501:])]
    rng.shuffle(texts)
    ids = list(range(len(texts)))
    docs = code.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    monkeypatch.setattr(lsh_forest, "REGION_BYTES", 10_000)
    got = table_of(lsh_forest.groups(docs, size=4))
    assert [got[i][0]["component_id"] for i in ids] == brute(ids, texts, 4)[1]


def test_query_against_all_pairs(code):
    sf = "/root/testdata/sf0.001"
    docs = code.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    n, component = brute([d["doc_id"] for d in docs], [d["text"] for d in docs], 4)
    got = table_of(QUERIES["op6_minhash_near_dedup"](code, sf))
    assert [got[d["doc_id"]][0]["component_id"] for d in docs] == component
    assert [got[d["doc_id"]][0]["n_shingles"] for d in docs] == n
