"""Whole texts to token ids with the tokenizers library, through bounded per-worker tables of known chunks.

A text without two white-space characters in a row is cut at its spaces and line ends: in both supported kinds (byte
level, and lower-cased words with white space dropped) a single space begins a new piece and a single line end is a
piece of its own or nothing, so the ids of a text are those of its chunks one after another.  Other texts go to the
library whole.  Arrow finds the distinct chunks of some megabytes of text at once; a chunk that the worker meets for
the first time is encoded by the library: plain words straight by its model, a word with marks after it as both
parts, and all else by the whole tokenizer.  Texts that hold the string of a special token also go to the library whole,
which gives that token's id for it, as it does by default.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CHUNKS = 300_000    # entries of a table; a full one becomes the older one, from which chunks still in use return
LONGEST_KEPT = 64       # characters of a chunk that is kept
AT_ONCE = 4 << 20       # bytes of text that are worked on together
_WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)").fullmatch    # no apostrophe: it can begin a piece
_FOLDS_ALONE = "İ"  # letters before this one stay one letter when they are normalised and folded
_WHITE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ``n`` values of ``flat`` from each ``start``, one run after another."""
    kind = np.int32 if ends[-1] < 1 << 31 else np.int64
    at = np.repeat((start - (ends - n)).astype(kind), n)
    at += np.arange(len(at), dtype=kind)
    return flat[at]


class TextEncoder:
    def __init__(self, path: str, max_chunks: int = MAX_CHUNKS):
        self.max_chunks = max_chunks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True       # in chunks, their strings are ordinary text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]           # found in raw texts before anything else
        self.added_anywhere = self.tokenizer.normalizer is not None and any(t.normalized for t in added)
        self.model = self.tokenizer.model
        self.folds = self.tokenizer.normalizer is not None
        # The printable characters that stand for single bytes in the vocabulary.
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.space = "" if self.folds else self.as_bytes(" ")[0][0]
        self.line_end = self.plain("\n")
        self.first, self.later = _Known(self, ""), _Known(self, " ")

    def by_library(self, text: str) -> bytes:
        """Ids of a whole text as the library gives them by default."""
        self.tokenizer.encode_special_tokens = False
        ids = self.plain(text)
        self.tokenizer.encode_special_tokens = True
        return ids

    def plain(self, chunk: str) -> bytes:
        return _pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def word(self, word: str, lead: str) -> bytes:
        """Ids of a chunk of letters only."""
        if not word.isascii():
            if self.folds and max(word) >= _FOLDS_ALONE:
                return self.plain(lead + word)
            word = self.as_bytes(word.lower() if self.folds else word)[0][0]
        elif self.folds:
            word = word.lower()
        return _pack([t.id for t in self.model.tokenize(self.space + word if lead else word)])

    def chunk(self, chunk: str, lead: str) -> bytes:
        if chunk.isalpha():
            return self.word(chunk, lead)
        both = _WORD_AND_MARKS(chunk)
        if both and both[1].isalpha() and (not self.folds or max(chunk) < _FOLDS_ALONE):
            return (self.later if lead else self.first)[both[1]] + self.first[both[2]]
        return self.plain(lead + chunk) if lead or chunk else b""

    def part(self, part: str) -> bytes:
        """Ids of what stands between two spaces of the prepared texts."""
        if part[:1] != "\n":
            return self.later[part]
        return self.first[part[2:]] if part[1:2] == "\n" else self.line_end + self.first[part[1:]]

    def _encode_clean(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if self.folds:      # white space is dropped, so a chunk is the same wherever it stands
            # Folding plain ASCII early, where nothing can combine, leaves fewer different chunks.
            texts = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(texts), texts)
            texts, ids_of = pc.replace_substring(texts, "\n", " "), self.later.__getitem__
        else:               # what follows a line end, or begins a text, is marked by one or by two line ends
            texts = pc.binary_join_element_wise("\n\n", pc.replace_substring(texts, "\n", " \n"), "")
            ids_of = self.part
        parts = pc.split_pattern(texts, " ")
        words = parts.flatten().dictionary_encode()
        own = list(map(ids_of, words.dictionary.to_pylist()))
        flat = np.frombuffer(b"".join(own), "<u4")
        size = np.fromiter(map(len, own), np.int32, len(own)) // 4
        start = np.cumsum(size, dtype=np.int32) - size
        index = words.indices.to_numpy()
        n = size[index]
        ends = np.cumsum(n, dtype=np.int64)
        ids = _gather(flat, start[index], n, ends)
        borders = parts.offsets.to_numpy()
        borders = np.concatenate(([0], ends[borders[1:] - borders[0] - 1]))
        return (ids[a:b] for a, b in zip(borders, borders[1:]))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        texts = texts.cast(pa.string())
        whole = pc.match_substring_regex(texts, _WHITE + _WHITE)
        for token in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        if self.added_anywhere:
            whole = pc.or_(whole, True)
        clean = texts.filter(pc.invert(whole))
        got = self._encode_clean(clean) if len(clean) else iter(())
        for is_whole, text in zip(whole.to_pylist(), texts):
            yield np.frombuffer(self.by_library(text.as_py()), "<u4") if is_whole else next(got)


class _Known(dict):
    """Ids of known chunks."""

    def __init__(self, encoder: TextEncoder, lead: str):
        super().__init__()
        self.encoder, self.lead, self.older = encoder, lead, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encoder.chunk(chunk, self.lead)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= self.encoder.max_chunks:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str, max_chunks: int) -> TextEncoder:
    return TextEncoder(path, max_chunks)


def encode_all(path: str, texts: pa.Array, max_chunks: int = MAX_CHUNKS) -> Iterator[np.ndarray]:
    """Ids of each text of a column without nulls, as unsigned 32-bit integers; a bounded amount of text at a time."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + AT_ONCE, side="right")))
        yield from encoder(path, max_chunks).encode(texts.slice(lo, hi - lo))
        lo = hi
