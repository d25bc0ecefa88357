import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import line_dedup
from trestle.llm.common import land
from trestle.llm.queries import ORACLE_SQL, QUERIES


def apart(a, b):
    """Word edit distance of at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def brute_keys(docs):
    """Dropped lines of each document: an id (null first) and a text's MD5."""
    docs = {((-1 << 63 if i is None else i), "" if t is None else hashlib.md5(t.encode()).hexdigest()): t for i, t in docs}
    lines = [(doc, k, tuple(re.findall(r"[^\x20\x09-\x0D]+", line)))
             for doc, text in docs.items() if text is not None for k, line in enumerate(text.split("\n"))]
    lines = sorted(x for x in lines if x[2])
    gone = {}
    for i, (doc, k, w) in enumerate(lines):
        for other, j, v in lines[:i]:
            if w == v or min(len(w), len(v)) >= line_dedup.FUZZY and apart(w, v):
                gone.setdefault(doc, []).append(k)
                break
    return gone


def brute(docs):
    return {doc: lines for (doc, _), lines in brute_keys(docs).items()}


def ids_of(df):
    return {r["doc"]["id"]: r["dropped"] for r in df.collect()}


def random_docs(seed, n):
    rng = random.Random(seed)
    pool = [[rng.choice("abcdef") * rng.randint(1, 3) for _ in range(rng.randint(1, 14))] for _ in range(40)]
    docs = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(w) + 1)
                w[k:k + rng.randint(0, 1)] = rng.choice([[], ["new"], [str(rng.randint(0, 3))]])
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        docs.append((i, "\n".join(lines)))
    return docs


@pytest.mark.parametrize("long_line", [line_dedup.LONG, 9, 0])
def test_against_all_pairs(code, long_line):
    docs = random_docs(long_line, 120)
    df = code.createDataFrame(docs, "doc_id long, text string")
    assert ids_of(line_dedup.dropped_lines(df, long_line=long_line)) == brute(docs)


def test_one_common_line_with_a_changing_word(code):
    docs = [(i, f"page {i} of the long report on many things") for i in range(400)] + [(1000, "the other line")]
    df = code.createDataFrame(docs, "doc_id long, text string")
    assert set(ids_of(line_dedup.dropped_lines(df))) == set(range(1, 400))


def test_longer_and_shorter_lines(code):
    base = "one two three four five six seven eight nine".split()
    docs = [(1, " ".join(base)), (2, " ".join(base[1:])), (3, " ".join([*base, "ten"])), (4, " ".join(base[:7])),
            (5, " ".join(base[:4] + ["x"] + base[4:])), (6, " ".join([*base[1:], base[0]]))]
    df = code.createDataFrame(docs, "doc_id long, text string")
    assert set(ids_of(line_dedup.dropped_lines(df))) == {2, 3, 5, 6} == set(brute(docs))


def test_odd_rows(odd_docs, no_docs):
    got = table_of(line_dedup.report(odd_docs))
    assert got[0][0]["n_lines"] == 0 and got[1][0]["n_lines"] == 1
    assert got[12][0]["dropped"] == [0] and got[6][0]["dropped"] == []
    assert [r["dropped"] for r in got[5]] == [[], []]
    assert got[None][0]["n_kept"] == 1
    assert line_dedup.report(no_docs).count() == 0
    left = line_dedup.apply(odd_docs)
    assert left.schema.simpleString() == odd_docs.schema.simpleString()
    rows = {r["line"]: r["text"] for r in left.collect()}
    assert rows == {i: t for i, t in enumerate(ODD_TEXTS) if i != 12}


def test_texts_that_share_an_id(code):
    docs = [(3, "alpha beta gamma delta"), (7, "alpha beta gamma delta\nseven a b c"),
            (7, "another seven text entirely\nmore words of it"), (None, "only here\nalpha beta gamma delta"),
            (None, "and here\nonly here"), (7, "another seven text entirely\nmore words of it"), (7, None), (None, None)]
    docs += [(k % 3 or None, t) for k, t in random_docs(17, 60)]
    df = code.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, n long")
    gone = brute_keys(docs)
    want = []
    for i, t in docs:
        drop = gone.get((-1 << 63 if i is None else i, hashlib.md5((t or "").encode()).hexdigest()), [])
        want.append((i, [] if t is None else drop))
    got = line_dedup.report(df).collect()
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["dropped"])) for r in got)
    left = {r["n"]: r["text"] for r in line_dedup.apply(df).collect()}
    assert left[2] == left[5] == docs[2][1] and left[1] == "seven a b c" and left[6] is None
    assert {left.get(3), left.get(4)} >= {"and here"} or left[4] == "and here\nonly here"


def test_rows_grow_with_the_table_when_every_id_is_null(code, monkeypatch):
    """No join pairs the rows of one id: what is landed and returned grows in proportion."""
    def landed(n):
        sizes = []
        with monkeypatch.context() as m:
            m.setattr(line_dedup, "land", lambda df: sizes.append((out := land(df)).count()) or out)
            docs = [(None, f"a line of text number {i} with its own words {i * 7}\nthe end {i}") for i in range(n)]
            sizes.append(line_dedup.report(code.createDataFrame(docs, "doc_id long, text string")).count())
        return sizes

    assert all(b <= 4.2 * max(a, 1) for a, b in zip(landed(100), landed(400)))


@pytest.mark.parametrize("keys", [1, 7])
def test_colliding_hashes_lose_no_line(code, monkeypatch, keys):
    docs = random_docs(23, 80)
    monkeypatch.setattr(line_dedup, "_key", lambda n, by_place, all_words: F.pmod(F.xxhash64(by_place, all_words), F.lit(keys)))
    df = code.createDataFrame(docs, "doc_id long, text string")
    assert ids_of(line_dedup.dropped_lines(df)) == brute(docs)


def test_short_lines(code):
    docs = [(1, "Menu\nHome page\n\nx"), (2, "Menu\nHome  page\n\ny"), (3, "Menu")]
    df = code.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in line_dedup.apply(df).collect()} == {1: docs[0][1], 2: "\ny"}


def test_texts_after(code):
    docs = code.createDataFrame([(1, "a b c\n\nx", 8), (2, "keep this line\na b c\n", 21), (3, "a b c", 5), (4, "", 0)],
                                "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.apply(docs).collect()}
    assert got == {1: ("a b c\n\nx", 8), 2: ("keep this line\n", 15), 4: ("", 0)}


def test_query_against_sql(code, duck):
    got = QUERIES["op4_line_dedup"](code, "/root/testdata/sf0.001")
    want = duck.execute(ORACLE_SQL["op4_line_dedup"])
    columns = [d[0] for d in want.description]
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_no_python_in_the_plans(code, monkeypatch):
    from trestle.llm import line_dedup as module

    plans = []
    monkeypatch.setattr(module, "land", lambda df: plans.append(df) or df)
    docs = code.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plans.append(module.report(docs))
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
