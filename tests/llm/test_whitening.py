import math

import numpy as np
import pytest

from trestle.llm import whitening as W
from trestle.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, n long, component string"


def expected(rows, most=16):
    """n, deviation and whitened values up to signs, by numpy's own eigenvectors."""
    rows = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors.T[::-1]
    k = min(most, int((values > 1e-9 * values[0]).sum()))
    out = []
    for i, x in rows:
        y = np.array([c - s / n for c, s in zip(x, sums)])
        out.append((i, n, sum((n * c - s) ** 2 for c, s in zip(x, sums)), (vectors[:k] @ y) / np.sqrt(values[:k])))
    return out, values[:k] / values.sum()


def compare(got, rows):
    want, explained = expected(rows)
    by_row = {}
    for r in got.collect():
        by_row.setdefault((r["vec_id"], r["deviation"]), []).append(r)
        assert r["identity_error"] <= 1e-6
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    signs = None
    for i, n, deviation, values in want:
        mine = sorted(by_row[i, deviation], key=lambda r: r["component"])
        mine = mine[::len(mine) // len(values)]             # repeated rows
        assert [r["component"] for r in mine] == list(range(1, len(values) + 1)) and {r["n"] for r in mine} == {n}
        whitened = np.array([r["whitened"] for r in mine])
        signs = np.sign(whitened * values) if signs is None else signs
        assert np.allclose(whitened, signs * values, atol=1e-6)
    assert got.count() == len(want) * len(explained)


def test_query_against_numpy(code):
    from trestle.llm.queries import QUERIES

    rows = [(r["vec_id"], r["embedding"]) for r in table(code, "/root/testdata/sf0.01", "embeddings").collect()]
    got = QUERIES["op11_embedding_whitening"](code, "/root/testdata/sf0.01")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got, rows)


def test_odd_rows(code):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(40)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (90, None), (91, []), (92, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (93, [math.nan] * 6),
             (94, [math.inf, *[0.0] * 5]), (95, [1e30, *[0.0] * 5]), (96, [1.0, 2.0])]
    df = code.createDataFrame([(i, v, 1, "c") for i, v in rows], SCHEMA).repartition(3)
    rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows if i not in (95, 96)]
    compare(W.whiten(df), rows)


def test_too_few_vectors(code):
    df = code.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [1.0, 2.0], 0, "")], SCHEMA)
    assert W.whiten(df).count() == 0
    assert W.whiten(df.filter("false")).count() == 0
    two = code.createDataFrame([(1, [1.0, 2.0], 0, ""), (2, [2.0, 2.0], 0, "")], SCHEMA)
    got = W.whiten(two).collect()
    assert sorted(abs(r["whitened"]) for r in got) == [1.0, 1.0] and {r["explained"] for r in got} == {1.0}


def test_deviations_beyond_a_long():
    m = W.Whitening(1 << 30, [(1 << 30) * 5 + 3, 0], np.ones(1), np.ones((1, 2)), 1.0)
    x = np.array([[6, 1], [1 << 40, 0]])
    assert m.deviations(x) == [((1 << 30) * 6 - m.sums[0]) ** 2 + (1 << 60), None]


@pytest.mark.parametrize("kind", ["random", "equal", "multiple", "low rank", "close", "graded"])
def test_spectrum(kind):
    rng = np.random.default_rng(1)
    d = 40
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    values = {"random": rng.random(d), "equal": np.full(d, 3.0), "multiple": np.repeat([5, 4, 1, 1], 10),
              "low rank": np.concatenate([rng.random(4), np.zeros(d - 4)]), "close": 1 + 1e-9 * np.arange(d),
              "graded": 10.0 ** -np.arange(d)}[kind]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, vectors = W.Spectrum(a).leading(16)
    want = np.linalg.eigvalsh(a)[::-1][:len(got)]
    assert len(got) == {"low rank": 4}.get(kind, len(got)) and (kind == "graded" or len(got) >= 4)
    assert np.abs(got - want).max() < 1e-13 * want[0] and np.abs(vectors @ vectors.T - np.eye(len(got))).max() < 1e-12
    assert max(np.linalg.norm(a @ v - e * v) for e, v in zip(got, vectors)) < 1e-13 * want[0]


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for d in (1, 2, 7, 30):
        for _ in range(10):
            a = rng.normal(size=(d, d)) * (rng.random((d, d)) < 0.4)
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            assert W.inertia(a) == ((values > 1e-9).sum(), (values < -1e-9).sum())
    assert W.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 1)
