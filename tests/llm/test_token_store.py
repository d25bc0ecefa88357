import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import token_store, tokens
from trestle.llm.queries import QUERIES

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PARTS = ["a", "th", "ing", "e", "é", "ß", "\U0001d11e", "中", "١", "'s", "'", "#", "12", " ", " ", "  ",
         "\n", "\t", "\x1c", "\x85", " ", "　", "A", "Σ", "́", "ǅ", "İ", "K", ",", ".", "<|endoftext|>",
         " word,", " Word.", "ö", "I"]


@pytest.mark.parametrize("file", FILES)
def test_chunks_give_the_ids_of_the_library(file):
    enc = tokens.TextEncoder(public_tokenizers.path(file), max_chunks=50)     # tables that fill up again and again
    rng = random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    texts += ["", " ", "\n", "a ", " a", "a\n", "\na", "a<|endoftext|>b c", "<|startoftext|> x", "<|ENDOFTEXT|>", "<|endoftext|>",
              *[t for t in ODD_TEXTS if t]]
    for text, ids in zip(texts, enc.encode(pa.array(texts))):
        assert ids.tobytes() == enc.by_library(text), repr(text)


def test_index_is_minimal_and_perfect():
    for n in (1, 2, 3, 50, 5000):
        h = token_store.hashes(np.arange(n), np.zeros(n, np.int64))
        at = token_store.find(token_store.build_seeds(h), h)
        assert sorted(at.tolist()) == list(range(n))


def test_query_against_the_library(code):
    sf = "/root/testdata/sf0.001"
    t = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    start = 0
    got = table_of(QUERIES["op10_token_store"](code, sf))
    docs = code.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = np.array(t.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert got[d["doc_id"]] == [{"doc_id": d["doc_id"], "start": start, "n_tokens": len(ids),
                                     "ids_crc32": zlib.crc32(ids.tobytes())}]
        start += len(ids)


def test_odd_rows_unknown_keys_and_width(code, odd_docs, no_docs):
    path = public_tokenizers.path(FILES[0])
    store = token_store.write(odd_docs, path, end_id=2, width=4)
    keys = code.read.parquet(f"{store.root}/entries").select("doc_id", "copy")
    assert {(r["doc_id"], r["copy"]) for r in keys.collect()} == {
        *((i, 0) for i in range(len(ODD_TEXTS)) if i != 3), (None, 0), (5, 1)}
    more = keys.union(code.createDataFrame([(i, 0) for i in range(1000, 1200)] + [(7, 1)], "doc_id long, copy int"))
    found = token_store.lookup(code, store, more)
    assert found.count() == len(ODD_TEXTS) + 1
    got = sorted((r["start"], r["n_tokens"]) for r in token_store.read_digests(code, store, found).collect())
    assert got[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))
    empty = token_store.write(no_docs, path, end_id=2)
    assert token_store.read_digests(code, empty, token_store.lookup(code, empty, keys)).count() == 0


def test_null_and_zero_are_different_keys():
    rows = pd.DataFrame({"key": [0, 0], "copy": [0, 0], "is_null": [0, 1]})
    assert len(set(token_store._keys(rows).tolist())) == 2


def test_keys_that_no_displacement_parts_are_an_error():
    h = token_store.hashes(np.array([5, 5, 6]), np.zeros(3, np.int64))
    with pytest.raises(ArithmeticError):
        token_store.build_seeds(h)


def test_one_id_on_many_rows(code):
    docs = code.range(300).selectExpr("if(id < 280, 7, if(id < 290, null, id)) as doc_id", "concat('text number ', id) as text")
    store = token_store.write(docs, public_tokenizers.path(FILES[0]), end_id=2)
    keys = code.read.parquet(f"{store.root}/entries").select("doc_id", "copy")
    assert keys.filter("doc_id = 7").distinct().count() == 280
    assert token_store.read_digests(code, store, token_store.lookup(code, store, keys)).count() == 300
