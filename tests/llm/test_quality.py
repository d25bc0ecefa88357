import random
import re

import pytest

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import quality
from trestle.llm.queries import ORACLE_SQL, QUERIES


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p + k for x in places.values() if len(x) > 1 for p in x for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    m = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
         "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    rules = (m["n_words"] < 20, 100 * m["n_repeat_words"] > 30 * m["n_words"], 10 * m["n_symbols"] > m["word_chars"],
             m["n_dup_lines"] >= 3 and 2 * m["n_dup_lines"] > m["n_lines"], m["word_chars"] < 2 * m["n_words"],
             m["word_chars"] > 40 * m["n_words"])
    return m | {"failures": sum(1 << i for i, x in enumerate(rules) if x)}


@pytest.fixture(scope="module")
def random_docs(code):
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        words = [rng.choice(["ab", "c", "#", "d\n", "e\n\n", "long-word", "|", "éé"]) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.5 and len(words) > 20:
            words[10:10] = words[:rng.randint(5, 18)] * rng.randint(1, 3)
        texts.append(rng.choice([" ", "\t", "  "]).join(words))
    return code.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


def test_measurements_against_plain_python(random_docs):
    docs, texts = random_docs
    got = table_of(quality.ledger(docs))
    for i, text in enumerate(texts):
        assert {k: v for k, v in got[i][0].items() if k != "doc_id"} == plain(text), repr(text)


def test_odd_rows(odd_docs, no_docs):
    got = table_of(quality.ledger(odd_docs))
    for i, text in enumerate(ODD_TEXTS):
        own = got[i if i != 3 else None][0]
        assert {k: v for k, v in own.items() if k != "doc_id"} == plain(text)
    assert got[0][0]["failures"] & quality.BIT["too_few_words"]
    assert quality.ledger(no_docs).count() == 0
    kept = quality.keep(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted(r["line"] for r in kept.collect()) == sorted(
        [i for i, t in enumerate(ODD_TEXTS) if plain(t)["failures"] == 0]
        + ([5] if plain(ODD_TEXTS[5])["failures"] == 0 else []))


def test_ablation_counts(random_docs):
    docs, texts = random_docs
    own = [plain(t)["failures"] for t in texts]
    got = {(r["policy"], r["rule"]): (r["n_failed"], r["n_only_this"])
           for r in quality.ablation(quality.ledger(docs)).collect()}
    assert len(got) == sum(map(len, quality.POLICIES.values()))
    for (policy, rule), n in got.items():
        m, b = quality.mask(policy), quality.BIT[rule]
        assert n == (sum(bool(x & b) for x in own), sum(x & m == b for x in own))


def test_query_against_sql(code, duck):
    got = QUERIES["op8_quality_rules"](code, "/root/testdata/sf0.001")
    want = duck.execute(ORACLE_SQL["op8_quality_rules"])
    columns = [d[0] for d in want.description]
    assert sorted(map(str, got.select(*columns).toPandas().itertuples(index=False, name=None))) == sorted(
        map(str, want.fetchall()))


def test_no_python_in_the_plan(code):
    df = QUERIES["op8_quality_rules"](code, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
