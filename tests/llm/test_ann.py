import math

import numpy as np

from trestle.llm import ann
from trestle.llm.queries import QUERIES


def exact(ids, x, top=ann.TOP):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = x @ q
            order = [k for k in np.lexsort((ids, -s)) if ids[k] != i][:top]
            out[int(i)] = [(int(ids[k]), float(s[k])) for k in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(got) + 1
        got.append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    for q, near in got.items():
        assert len(near) == len(want[q]) and q not in [i for i, _ in near]
        assert [(-s, i) for i, s in near] == sorted((-s, i) for i, s in near)
    return np.mean([i in {j for j, _ in got[q]} for q in want for i, _ in want[q]])


def frame(code, ids, x):
    return code.createDataFrame([(int(i), [float(c) for c in v], 0, 0) for i, v in zip(ids, x)],
                                "vec_id long, embedding array<float>, rank int, score int")


def test_curve_visits_neighbouring_cells_one_after_another():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = ann.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1)
        assert (steps == 1).all()


def test_query_recall(code):
    sf = "/root/testdata/sf0.01"
    rows = code.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    assert recall(found(QUERIES["op1_hilbert_ann"](code, sf)), exact(ids, x)) >= 0.9


def test_query_recall_with_blocks_much_smaller_than_the_table(code, monkeypatch):
    """2,000 vectors without structure in blocks of 64: what the windows leave out is really not looked at."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "WIDE", 2)
    sf = "/root/testdata/sf0.1"
    rows = code.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    assert len(ids) >= 2000 and recall(found(QUERIES["op1_hilbert_ann"](code, sf)), exact(ids, x)) >= 0.9


def test_narrow_windows_on_clusters(code, monkeypatch):
    """Blocks much smaller than the table: the windows, not the whole table, must hold the neighbours."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "WIDE", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    x = np.float32(centres[rng.integers(0, 60, 3000)] + 0.1 * rng.normal(size=(3000, 16))).astype(np.float64)
    ids = rng.permutation(3000)
    assert recall(found(ann.search(frame(code, ids, x))), exact(ids, x)) >= 0.9


def test_ties_and_one_very_common_vector(code):
    rng = np.random.default_rng(4)
    x = np.float32(rng.normal(size=(500, 8))).astype(np.float64)
    x[100:300] = x[100]
    ids = rng.permutation(500)
    got, want = found(ann.search(frame(code, ids, x))), exact(ids, x)
    assert recall(got, want) == 1.0
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_norms_count(code):
    rng = np.random.default_rng(5)
    x = np.float32(rng.normal(size=(400, 6)) * rng.choice([0.01, 1, 50], size=(400, 1))).astype(np.float64)
    ids = np.arange(400)
    assert recall(found(ann.search(frame(code, ids, x))), exact(ids, x)) >= 0.9


def test_odd_rows(code):
    schema = "vec_id long, embedding array<double>, score double"
    rows = [(0, [1.0, 0.0], 1.0), (20, [0.0, 2.0], None), (1, [1.0, 1.0], 0.0), (2, None, 0.0), (3, [], 0.0),
            (4, [0.0, 0.0], 0.0), (5, [None, 1.0], 0.0), (6, [math.nan, 1.0], 0.0), (7, [math.inf, 1.0], 0.0),
            (8, [1.0, 1.0, 1.0], 0.0), (None, [9.0, 9.0], 0.0), (1, [1.0, 1.0], 5.0), (40, [0.0, 0.0], 0.0)]
    got = found(ann.search(code.createDataFrame(rows, schema)))
    assert got == {0: [(1, 1.0), (20, 0.0)], 20: [(1, 2.0), (0, 0.0)]}
    assert ann.search(code.createDataFrame([], schema)).count() == 0
    assert ann.search(code.createDataFrame(rows[2:4], schema)).count() == 0
    assert ann.search(code.createDataFrame(rows[:1], schema)).count() == 0
