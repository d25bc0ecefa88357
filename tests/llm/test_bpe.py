import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import ODD_TEXTS, table_of
from trestle.llm import bpe
from trestle.llm.queries import QUERIES

FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "th", "ing", "e", "é", "ß", "\U0001d11e", "中", "١", "'s", "#", "12", " ", "  ", "\n",
         "\t", "\x85", " ", "A", "aaaa", "́", "the ", " word", ",", "\r\n"]


@pytest.fixture(params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    own = bpe.codec(path, public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_same_ids_as_the_library_and_round_trip(both):
    own, library = both
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 300, *[t for t in ODD_TEXTS if t]]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text), text
        assert own.decode(ids).decode() == text


def test_spaces_beside_other_white_space(both):
    own, library = both
    rng = random.Random(6)
    parts = ["a", "word", "1", ",", "'s", " ", " ", "\n", "\r\n", "\t", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\x1c", "\u200b"]
    texts = ["a \xa0 \xa0 b", " \xa0 \xa0", "x \xa0 \xa0", "\n \n", "a\n ", "a \n b", " \n", "\n a", " "]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    for text in texts:
        assert own.encode(text) == library.encode_ordinary(text), text
        pieces = own.pieces(text)
        if "  " not in text and not bpe._INNER_SPACE(text):     # cut at spaces: the same pieces
            first, *rest = text.split(" ")
            assert pieces == [p for c in [first, *(" " + x for x in rest)] for p in own.pieces(c)], text


def test_every_token_is_whole_and_long_pieces_take_linear_steps(both):
    own, library = both
    for token in list(own.ranks)[::97]:
        assert own.encode_piece(token) == [own.ranks[token]]
    rng = random.Random(1)
    long = bytes(rng.choice(b"abcdehinorst") for _ in range(100_000))
    assert own.encode_piece(long) == library._encode_single_piece(long)


def test_small_rank_file_with_prefix_of_later_rank():
    ranks = {bytes([b]): i for i, b in enumerate(b"abcx")}
    ranks |= {b"ab": 4, b"abab": 5, b"bx": 6, b"aba": 7}
    own = bpe.ByteBpe(ranks, r"\w+")
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 14)))
        assert own.encode(text) == library.encode_ordinary(text), text


def test_query_against_the_library(code):
    sf = "/root/testdata/sf0.001"
    own = bpe.codec(public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in code.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_byte_bpe"](code, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs):
    path = public_tokenizers.path(FILES[0])
    got = table_of(bpe.round_trip(odd_docs, path, public_tokenizers.PATTERN))
    assert got[0][0]["n_tokens"] == 0 and got[0][0]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert len(got[5]) == 2 and got[5][0] == got[5][1]
    assert None in got
    encoded = bpe.encode(odd_docs, path, public_tokenizers.PATTERN)
    back = table_of(bpe.decode(encoded, path, public_tokenizers.PATTERN))
    for i, text in enumerate(ODD_TEXTS):
        if i != 3:
            assert bytes(back[i][0]["bytes"]).decode() == (text or "")
    assert bpe.round_trip(no_docs, path, public_tokenizers.PATTERN).count() == 0
