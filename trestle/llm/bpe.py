"""Byte-level BPE encoding and decoding by longest matches and backtracking.

The bytes of a piece are read as Latin-1 characters, so that a character automaton (pyahocorasick) over the
vocabulary finds, in one pass, the longest token that starts at each byte.  The encoder walks from left to right,
takes the longest token that may stand after the one before it, shortens it where it may not, and steps back from
places that no token sequence can leave.  Two tokens may stand next to each other exactly if merging their joined
bytes by rank would give these two tokens again; that answer is memoised by pair.  Each place is entered at most once
per token that ends there, so the work is linear in the length of the piece.

A document is cut at single spaces first, because such a space begins a piece unless it stands inside a run of white
space or ends one at the end of the text; chunks and pieces that were met before come from bounded per-worker tables.

Defined cases: a null text counts as empty; an empty text has no ids, the digest of the empty string and decodes to
no bytes; repeated rows are encoded each on its own; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from trestle.llm.common import map_batches, texts

MAX_CHUNKS = 400_000   # entries of a worker's tables of chunks and of pieces; a full table is emptied
MAX_PAIRS = 2_000_000
_INNER_SPACE = re.compile(r"(?<=\s) (?:\s|\Z)").search    # a space that belongs to the piece before it


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}    # token -> the two tokens that were merged into it
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}               # token -> its longest proper prefix that is a token, or -1
        self._learn_merges()
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank in self.halves:
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.by_text = {str(i): b for i, b in self.bytes_of.items()}
        self.piece_ids: dict[str, str] = {}
        self.after_space = _Chunks(self, " ")
        self.plain = _Chunks(self, "")

    def _learn_merges(self) -> None:
        """Split every token into its two parts, in the order of the ranks.

        Tokens that no merge can make keep no parts; they are only used where they are a whole piece.
        """
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                continue
            for k in range(len(token) - 1, 0, -1):
                left, right = self.ranks.get(token[:k], rank), self.ranks.get(token[k:], rank)
                if left < rank > right and left in self.halves and right in self.halves and self._stands(left, right):
                    self.halves[rank] = (left, right)
                    self.merged[left, right] = rank
                    break
        for token, rank in self.ranks.items():    # a prefix can have a later rank than the token itself
            prefixes = (self.ranks.get(token[:k], -1) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in self.halves), -1)

    def _stands(self, left: int, right: int) -> bool:
        """True if merging by rank never joins bytes across the border between the two tokens.

        The merges that made both tokens are undone from the latest to the earliest.  At each step the two tokens
        that touch the border must not have a merge of their own that comes before the one undone last.
        """
        before = len(self.ranks) * 2
        while True:
            if self.merged.get((left, right), before) < before:
                return False
            if left > right:
                before, left_part = left, self.halves[left][1]
                if left_part != left:
                    left = left_part
                    continue
                if len(self.bytes_of[right]) == 1:
                    return True
                before, right = right + 1, self.halves[right][0]
            else:
                before, right_part = right + 1, self.halves[right][0]
                if right_part != right:
                    right = right_part
                    continue
                if len(self.bytes_of[left]) == 1:
                    return True
                before, left = left, self.halves[left][1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, length, shorter, pairs = len(piece), self.length, self.shorter, self.pairs
        longest = [0] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token      # a later end at the same start is a longer token
        out: list[int] = []
        closed = set()
        at, last, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            fits = end not in closed
            if fits and last >= 0:
                fits = pairs.get((last, token))
                if fits is None:
                    fits = self._remember(last, token)
            if fits:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                closed.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1

    def _remember(self, left: int, right: int) -> bool:
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        got = self.pairs[left, right] = self._stands(left, right)
        return got

    def encode_chunk(self, chunk: str) -> str:
        """Decimal ids of every piece of a chunk, joined by one space."""
        out = []
        for piece in self.pieces(chunk):
            ids = self.piece_ids.get(piece)
            if ids is None:
                if len(self.piece_ids) >= MAX_CHUNKS:
                    self.piece_ids.clear()
                ids = " ".join(map(str, self.encode_piece(piece.encode())))
                if len(piece) <= 64:
                    self.piece_ids[piece] = ids
            out.append(ids)
        return " ".join(out)

    def encode_text(self, text: str) -> str:
        """Decimal ids of a whole text, joined by one space.

        A space begins a piece unless white space stands before it and white space or the end follows, so the text
        can be cut at its spaces.  Texts that hold such a space, or two spaces in a row, go through the pattern whole.
        """
        if not text:
            return ""
        if "  " in text or _INNER_SPACE(text):
            return self.encode_chunk(text)
        if len(self.after_space) + len(self.plain) > MAX_CHUNKS:
            self.after_space.clear()
            self.plain.clear()
        first, *rest = text.split(" ")
        ids = list(map(self.after_space.__getitem__, rest))
        return " ".join([self.plain[first], *ids] if first else ids)

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.by_text.__getitem__, ids.split(" "))) if ids else b""

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Chunks(dict):
    def __init__(self, codec: ByteBpe, lead: str):
        super().__init__()
        self.codec, self.lead = codec, lead

    def __missing__(self, chunk: str) -> str:
        ids = self.codec.encode_chunk(self.lead + chunk)
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    """One codec per worker process and rank file."""
    return ByteBpe(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text."""
    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            yield {"doc_id": b.column(0), "ids": [c.encode(t) for t in b.column(1).to_pylist()]}

    return map_batches(texts(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, bytes binary`` of every id list (null: no ids)."""
    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            yield {"doc_id": b.column(0), "bytes": [c.decode(x or []) for x in b.column(1).to_pylist()]}

    return map_batches(encoded.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` ids"), run,
                       "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The ids never leave the worker, so nothing but the digests is moved.
    """
    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1).to_pylist():
                ids = c.encode_text(text)
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode_text(ids)).hexdigest())
            yield {"doc_id": b.column(0), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return map_batches(texts(docs, id_col, text_col), run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
