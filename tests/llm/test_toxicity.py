import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import table_of
from trestle.llm import toxicity
from trestle.llm.queries import QUERIES

MILD = [a + b for a in ("ta", "re", "mi", "so", "lu") for b in ("ba", "no", "ki", "de", "ver", "lin")]
RUDE = {"en": ["grubba", "snarf"], "de": ["kwelch" + e for e in ("ig", "tum", "er", "en", "lo", "ös")]}


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(MILD) for _ in range(rng.randint(3, 80))]
        toxic = int(rng.random() < 0.4)
        for _ in range(2 * toxic):
            words[rng.randrange(len(words))] = rng.choice(RUDE[lang])
        rows.append((i, " ".join(words), lang, toxic))
    return rows


@pytest.fixture(scope="module")
def fitted(code):
    rows = corpus(1200, 1)
    docs = code.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = code.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    return rows, docs, labels, toxicity.fit(docs, labels)


def test_held_out_rows(fitted):
    rows, docs, _, model = fitted
    got = table_of(toxicity.score(docs, model))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[r[0]][0]["held_out"] for r in held)
    right = [got[r[0]][0]["predicted"] == r[3] for r in held]
    assert np.mean(right) > 0.95
    assert all(x["predicted"] == int(x["score"] >= 0.7) and 0 <= x["score"] <= 1 for v in got.values() for x in v)
    assert set(model.thresholds) <= {"en", "de"}


def test_score_depends_on_the_text_only(fitted, code):
    _, _, _, model = fitted
    docs = code.createDataFrame([(1, "taba snarf grubba", "en"), (2, "taba snarf grubba", "zz"), (3, "taba snarf grubba", None)],
                                "doc_id long, text string, lang string")
    assert len({r["score"] for r in toxicity.score(docs, model).collect()}) == 1


def test_one_word_in_a_long_text_counts(fitted):
    _, _, _, model = fitted
    scorer = toxicity.Scorer(model)
    long = " ".join(MILD * 400)
    assert scorer(long) < 0.7 < scorer(long[:20_000] + " snarf, grubba " + long)


def test_tables_that_fill_up_give_the_same_scores(fitted, monkeypatch):
    rows, _, _, model = fitted
    whole = toxicity.Scorer(model)
    want = [whole(r[1]) for r in rows[:80]]
    monkeypatch.setattr(toxicity, "MAX_WORDS", 10)
    small = toxicity.Scorer(model)
    assert np.allclose([small(r[1]) for r in rows[:80]], want, atol=1e-6)


def test_odd_rows_and_no_training_rows(fitted, odd_docs, no_docs, code):
    _, _, _, model = fitted
    got = table_of(toxicity.score(odd_docs, model))
    assert got[0][0]["score"] == got[1][0]["score"] == got[2][0]["score"]
    assert len(got[5]) == 2 and None in got
    assert toxicity.score(no_docs, model).count() == 0
    none = code.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.fit(odd_docs, none)
    assert {r["score"] for r in toxicity.score(odd_docs, empty).collect()} == {0.0}
    one_sided = code.createDataFrame([(i, 1) for i in range(13)], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.score(odd_docs, toxicity.fit(odd_docs, one_sided)).collect()} == {0}


def test_one_id_on_very_many_rows_does_not_outgrow_the_sample(code):
    labels = code.createDataFrame([(0, 1), (0, 0), *((i, i % 2) for i in range(2, 60))], "doc_id long, toxic int")
    docs = code.range(4000).selectExpr("cast(0 as long) doc_id", "concat('text ', id, repeat(' x', 20)) text", "'en' lang")
    docs = docs.union(code.range(60).selectExpr("id", "concat('other ', id)", "'en'")).unionAll(docs.limit(1000))
    got = toxicity.training_rows(docs, labels, sample=20, sample_chars=900).collect()
    for label in (0, 1):
        own = [r["text"] for r in got if r["label"] == label]
        assert 3 <= len(own) <= 40 and sum(map(len, own)) <= 900 and len(set(own)) == len(own)


def test_query_on_held_out_labels(code):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](code, sf).filter("held_out").collect()}
    labels = [r for r in code.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in got]
    toxic = [got[r["doc_id"]] for r in labels if r["toxic"] == 1]
    clean = [got[r["doc_id"]] for r in labels if r["toxic"] == 0]
    assert len(toxic) > 20 and len(clean) > 100
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in toxic + clean)
    # Some 290 toxic rows to learn from: 0.91 of the held-out toxic rows are found here, 1.00 with ten times as many.
    assert np.mean([r["predicted"] for r in toxic]) > 0.88 and np.mean([r["predicted"] for r in clean]) < 0.01


def test_query_shape(code):
    sf = "/root/testdata/sf0.001"
    df = QUERIES["op3_toxicity"](code, sf)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert df.count() == code.read.parquet(f"{sf}/documents.parquet").count()


def test_rows_beyond_the_start_are_learned_and_set_the_thresholds(code):
    rows = corpus(1500, 5)
    rows += [(5000 + i, f"taba reno {w} solin", "fr", k) for i, (w, k) in enumerate([("glorp", 1), ("miba", 0)] * 300)]
    docs = code.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(6)
    labels = code.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    whole = toxicity.all_training_rows(docs.union(docs), labels)
    assert whole.count() == sum(zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in rows)
    model = toxicity.fit(docs, labels, sample=60)
    got = table_of(toxicity.score(docs, model))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([got[r[0]][0]["predicted"] == r[3] for r in held]) > 0.93
    assert set(model.thresholds) == {"en", "de", "fr"}
    # The score's scale has the fewest errors over all rows kept for it, not over the start's.
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1 and toxicity.is_kept([r[0]])[0]]
    scores, truth = np.array([got[r[0]][0]["score"] for r in kept]), np.array([r[3] for r in kept])
    errors = [np.sum((scores >= c) != truth) for c in np.unique([*scores, 0, 1])]
    assert np.sum((scores >= 0.7) != truth) <= min(errors) + 1


def test_a_pass_moves_the_model_by_all_tasks(code):
    rows = corpus(600, 9)
    docs = code.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = code.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    whole = toxicity.all_training_rows(docs, labels)
    models = []
    for _ in range(2):
        t = toxicity.train([r[1] for r in rows[:40]], np.array([r[3] for r in rows[:40]], np.float32),
                           [r[2] for r in rows[:40]], np.zeros(40, bool))
        before = t.model.embedding.copy()
        toxicity.one_pass(whole, t, 0)
        models.append(t.model)
        moved = np.flatnonzero((before != t.model.embedding).any(1))
        words = {f for r in rows for w in toxicity.words(r[1]) for f in toxicity.features(w)}
        assert len(moved) and {*moved.tolist()} <= words
    assert np.array_equal(models[0].embedding, models[1].embedding)
    assert np.isfinite(models[0].embedding).all()


def test_texts_without_a_label_are_not_moved_to_the_join(code):
    docs = code.range(20_000).selectExpr("id doc_id", "concat('text ', id) text", "'en' lang")
    docs = docs.union(docs.limit(300)).union(code.sql("select cast(null as long), 'none', 'en'"))
    labels = code.range(0, 20_000, 50).selectExpr("id doc_id", "cast(id % 100 = 0 as int) toxic").union(
        code.sql("select cast(null as long), 1"))
    rows, marks = toxicity._rows_and_marks(docs, labels, "doc_id", "text", "toxic", "lang")
    few = toxicity.likely(rows, marks)
    want = {i for i in range(0, 20_000, 50) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert few.columns == rows.columns and len(want) < few.count() < 0.25 * rows.count()
    assert {r["_id"] for r in few.collect()} >= want
    code.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r["_id"], r["text"], r["label"]) for r in toxicity.all_training_rows(docs, labels).collect())
    finally:
        code.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(i, f"text {i}", int(i % 100 == 0)) for i in sorted(want)]
    as_text = labels.selectExpr("concat('0', doc_id) doc_id", "toxic")         # equal to the ids only as numbers
    assert toxicity.likely(rows, toxicity._rows_and_marks(docs, as_text, "doc_id", "text", "toxic", "lang")[1]) is rows


def test_features_are_those_of_characters():
    for w in ("a", "it's", "grubba", "überß", "ös", "abıcdéf", "日本語の文章", "\U0001f600x"):
        parts = [f"={w}", *(f"<{w[:k]}" for k in (3, 4, 5)), *(f"{w[-k:]}>" for k in (3, 4, 5))]
        want = tuple(toxicity.xxhash.xxh32_intdigest(p.encode()) % toxicity.ROWS for p in parts)
        assert toxicity.features(w.encode()) == want
