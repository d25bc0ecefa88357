import zlib

import numpy as np
import pytest

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import langid
from trestle.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(code):
    return langid.fit(code.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(code):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r for r in code.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op9_language_id"](code, sf).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert np.mean(held) > 0.97


def test_odd_rows(odd_docs, no_docs, model):
    got = table_of(langid.predict(odd_docs, model))
    letters = [bool(t) and any(c.isalpha() for c in t) for t in ODD_TEXTS]
    for i, has in enumerate(letters):
        r = got[i if i != 3 else None][0]
        assert (r["lang_pred"] == "und") == (not has)
        assert has or (r["score"] == 0 and r["rejected"])
    assert langid.predict(no_docs, model).count() == 0
    kept = langid.keep(odd_docs, model)
    assert kept.schema == odd_docs.schema
    assert not {0, 1, 2, 3} & {r["line"] for r in kept.collect()}


def test_learns_nothing_from_held_out_or_unlabelled_rows(code):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, "nur deutsche worte hier", "de") for i in ids] + [(100 + i, "ohne sprache", None) for i in range(5)]
    docs = code.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == []
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"und"}


def test_one_id_on_very_many_rows_does_not_outgrow_the_sample(code):
    rows = code.range(3000).selectExpr("cast(0 as long) doc_id", "concat('viele worte hier ', id) text", "'de' lang")
    rows = rows.unionAll(code.range(900).selectExpr("cast(null as long)", "'ein text'", "'de'"))
    rows = rows.unionAll(code.range(40).selectExpr("id + 5", "concat('some words ', id)", "'en'"))
    got = langid.bounded_sample(rows, {"de": 3900, "en": 40}, sample=30, sample_chars=400).collect()
    for lang in ("de", "en"):
        own = [r["text"] for r in got if r["lang"] == lang]
        assert 3 <= len(own) <= 60 and sum(map(len, own)) <= 400
    assert len({(r["doc_id"], r["text"]) for r in got}) == len(got)


def test_languages_and_centroids(code):
    rng = np.random.default_rng(1)
    alphabets = {"aa": "abcdefg", "bb": "klmnopq", "cc": "rstuvwx"}
    rows = [(i, " ".join("".join(rng.choice(list(alphabets[x]), 5)) for _ in range(12)), x)
            for i, x in enumerate(list(alphabets) * 60)]
    docs = code.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, sample=20)
    assert sorted(set(model.langs)) == sorted(alphabets) and len(model.langs) <= 3 * langid.CENTROIDS
    got = langid.predict(docs, model).collect()
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] for r in got)
    far = code.createDataFrame([(1, "中文文中 文中")], "doc_id long, text string")
    assert langid.predict(far, model).first()["rejected"]


def test_clusters_are_unit_rows():
    rng = np.random.default_rng(0)
    rows = np.abs(rng.normal(size=(50, 8))).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    got = langid.cluster(rows, 4)
    assert got.shape == (4, 8) and np.allclose(np.linalg.norm(got, axis=1), 1, atol=1e-5)
    assert len(langid.cluster(rows[:2], 4)) == 2


def test_centroids_and_limits_come_from_all_rows(code):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh" if i % 4 else "stuvwxyz"), 4)) for _ in range(9)), "aa" if i % 3 else "bb")
            for i in range(400)]
    docs = code.createDataFrame([*rows, *rows[:90]], "doc_id long, text string, lang string").repartition(7)
    model = langid.fit(docs, sample=5)
    for lang in ("aa", "bb"):
        own = [t for i, t, x in rows if x == lang and zlib.crc32(str(i).encode()) % 3 != 1]
        found, _ = langid.vectors(own, model.idf)
        centres = model.centres[[x == lang for x in model.langs]]
        near = found @ centres.T
        for j, c in enumerate(centres):
            assert (near.argmax(1) == j).any()
            assert np.allclose(c, langid.unit(found[near.argmax(1) == j].sum(0)[None])[0], atol=1e-5)
        want = langid.REJECT_PART * np.quantile(near.max(1), langid.REJECT_QUANTILE)
        assert np.allclose([x for x, y in zip(model.least, model.langs) if y == lang], want, atol=2e-6)


def test_sums_do_not_depend_on_the_order_of_rows(code):
    docs = code.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, other = langid.fit(docs), langid.fit(docs.orderBy("text").repartition(5))
    assert np.array_equal(one.centres, other.centres) and np.array_equal(one.least, other.least)


def test_the_pipeline_learns_from_all_rows(code, monkeypatch):
    import corpus_pipeline

    met = []
    whole = langid.next_round
    monkeypatch.setattr(langid, "next_round", lambda rows, *a: met.append(rows.count()) or whole(rows, *a))
    rows = [(i, f"wort {i} und mehr {i * 7}", "de", "x", 1.0) for i in range(4500)]
    docs = code.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    assert corpus_pipeline.language_id(code, docs, "").count() == len(rows)
    assert {*met} == {sum(zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in rows)}
