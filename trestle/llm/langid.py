"""Language identification by the nearest of several centroids per language.

A text becomes a normalised TF-IDF vector of hashed character n-grams (1 to 3 letters, other characters count as one
space).  Document frequencies are counted over all training rows, as one partial sum per task.  The distinct training
rows of every language are clustered into a few centroids by spherical k-means: each round is a pass over all of them,
with one partial sum per task and centroid.  Only the places where the rounds start come from few texts of bounded size
(``bounded_sample``).  A text gets the language of its most similar centroid by cosine; texts far from every centroid
are rejected, by limits that come from the similarities of all distinct training rows.

Only the text is ever looked at in a prediction.  Training uses rows with a language whose crc32(id) mod 3 is not 1.

Defined cases: null, empty and letterless texts are ``und`` with score 0 and are rejected; without training rows
everything is ``und``; repeated rows are judged each on its own; rows without a language are not learned from;
``keep`` passes all columns of its input through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trestle.llm.common import is_held_out, land, map_batches

BUCKETS = 4096
CENTROIDS = 4      # per language
SAMPLE = 1500      # distinct training texts per language among which k-means looks for its starts, twice as many at most
SAMPLE_CHARS = 30_000_000      # characters of them per language, at most
ROUNDS = 12
UNKNOWN = "und"
#: A text is rejected if it is less similar to its centroid than this part of the least similar training texts are.
REJECT_PART, REJECT_QUANTILE = 0.25, 0.001
#: Vectors are summed as multiples of 1 / UNIT, so that sums do not depend on how the rows are dealt to tasks.
UNIT = 1 << 24
BINS = 1 << 20     # steps between the similarities 0 and 1 in which the limits of rejection are found
STEP = 256         # texts that are vectors at the same time in a prediction
ROUND_STEP = 32    # and in a round of k-means


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur in the text; None if it has no letter."""
    x = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[x]
    if not is_letter.any():
        return None
    x = np.where(is_letter, x, 32)
    gap = ~is_letter
    x = x[~(gap & np.concatenate(([True], gap[:-1])))]      # one space for a run of other characters
    two = x[:-1] * np.uint32(65599) + x[1:]
    three = two[:-1] * np.uint32(65599) + x[2:]
    grams = np.concatenate((x, two + np.uint32(0x51ED27), three + np.uint32(0x3C6EF3)))
    grams ^= grams >> np.uint32(15)
    return np.bincount((grams * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=BUCKETS)


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows, and which texts have a letter."""
    rows, known = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        c = counts(text)
        if c is not None:
            rows[i], known[i] = np.sqrt(c) * idf, True
    return normalised(rows), known


def normalised(rows: np.ndarray) -> np.ndarray:
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    return rows


def starts(rows: np.ndarray, k: int = CENTROIDS) -> np.ndarray:
    """Spread-out rows (each the row least similar to those chosen before)."""
    found = [int(np.argmax(rows @ rows.mean(0)))]
    near = rows @ rows[found[0]]
    while len(found) < min(k, len(rows)):
        found.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[found[-1]])
    return rows[found]


def unit(sums: np.ndarray) -> np.ndarray:
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def cluster(rows: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means of rows in memory, from spread-out starts."""
    centres = starts(rows, k)
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        centres = unit(np.stack([rows[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    return centres.astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray           # per bucket
    centres: np.ndarray       # rows
    langs: list[str]          # per centre
    least: np.ndarray         # per centre: less similar texts are rejected

    def predict(self, texts: list[str | None], step: int = STEP):
        """Language, similarity and rejection of each text."""
        langs, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for lo in range(0, len(texts), step):
            rows, known = vectors(texts[lo:lo + step], self.idf)
            if not len(self.centres):
                langs += [UNKNOWN] * len(rows)
                continue
            near = rows @ self.centres.T
            best = near.argmax(1)
            top = np.clip(near[np.arange(len(rows)), best].astype(np.float64), 0.0, 1.0)
            langs += [self.langs[j] if k else UNKNOWN for j, k in zip(best, known)]
            scores[lo:lo + step] = np.where(known, top, 0.0)
            rejected[lo:lo + step] = ~known | (top < self.least[best])
        return langs, scores, rejected


def bounded_sample(rows: DataFrame, per_lang: dict[str, int], sample: int, sample_chars: int) -> DataFrame:
    """About ``sample`` distinct ``doc_id, text, lang`` of each language, never more than twice as many nor more than
    ``sample_chars`` characters (longer texts are no training texts).

    The draw is by a hash of id and text, so an id on very many rows has no more weight than others; repeated rows are
    made one by an aggregate before a language's rows meet.
    """
    share = F.lit(0)
    for lang, n in per_lang.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n) * 1e6)).otherwise(share)
    draw = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text", F.lit(9))
    drawn = rows.filter((F.pmod(draw, F.lit(1_000_000)) < share) & (F.length("text") <= sample_chars)).distinct()
    of_lang = Window.partitionBy("lang").orderBy(draw, "doc_id", "text")
    return drawn.select("*", F.row_number().over(of_lang).alias("k"), F.sum(F.length("text")).over(
        of_lang.rowsBetween(Window.unboundedPreceding, 0)).alias("chars")).filter(
        (F.col("k") <= 2 * sample) & (F.col("chars") <= sample_chars)).drop("k", "chars")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the rows of ``docs`` with a language that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out("doc_id"))

    def frequencies(batches):
        total, n = np.zeros(BUCKETS + 1, np.int64), {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[lang] = n.get(lang, 0) + 1
                c = counts(text)
                if c is not None:
                    total[:-1] += c > 0
        yield {"bucket": [*range(BUCKETS), *[None] * len(n)], "lang": [*[None] * BUCKETS, *n],
               "n": [*total[:-1].tolist(), *n.values()]}

    totals = map_batches(rows.select("text", "lang"), frequencies, "bucket int, lang string, n long")
    totals = totals.groupBy("bucket", "lang").agg(F.sum("n").alias("n")).collect()   # buckets and languages
    df = np.zeros(BUCKETS)
    per_lang = {r["lang"]: r["n"] for r in totals if r["bucket"] is None}
    for r in totals:
        if r["bucket"] is not None:
            df[r["bucket"]] = r["n"]
    idf = (np.log((1 + sum(per_lang.values())) / (1 + df)) + 1).astype(np.float32)

    chosen = bounded_sample(rows, per_lang, sample, sample_chars)

    def first(group):
        import pandas as pd

        found, known = vectors(group["text"].tolist(), idf)
        found = starts(found[known]) if known.any() else []
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(found), "centre": [c.tobytes() for c in found]})

    got = chosen.groupBy("lang").applyInPandas(first, "lang string, centre binary").collect()
    centres = {lang: np.stack([np.frombuffer(c, np.float32) for c in sorted(r["centre"] for r in got if r["lang"] == lang)])
               for lang in sorted({r["lang"] for r in got})}     # CENTROIDS rows per language
    if not centres:
        return Model(idf, np.zeros((0, BUCKETS), np.float32), [], np.zeros(0))
    # Texts are only moved if some rows stand there twice.
    if not rows.groupBy("doc_id", "lang", F.xxhash64("text")).count().filter("count > 1").isEmpty():
        rows = rows.distinct()
    rows = land(counted(rows))
    for _ in range(ROUNDS):
        new = next_round(rows, idf, centres)
        same = all(np.array_equal(new[lang], centres[lang]) for lang in centres)
        centres = new
        if same:
            break
    least = limits(rows, idf, centres)
    return Model(idf, np.concatenate([*centres.values()]), [lang for lang, c in centres.items() for _ in c],
                 np.array([least[lang] for lang, c in centres.items() for _ in c]))


def counted(rows: DataFrame) -> DataFrame:
    """``lang, at, n``: the buckets of each text with a letter and how often each occurs, so that the rounds need not
    count again."""
    def run(batches):
        for b in batches:
            out = {"lang": [], "at": [], "n": []}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = counts(text)
                if c is not None:
                    at = np.flatnonzero(c)
                    out["lang"].append(lang)
                    out["at"].append(at.astype(np.uint16).tobytes())
                    out["n"].append(c[at].astype(np.uint32).tobytes())
            yield out

    return map_batches(rows.select("text", "lang"), run, "lang string, at binary, n binary")


def _by_language(batches, idf: np.ndarray, centres: dict[str, np.ndarray]):
    """The vectors of ``lang, at, n`` and how similar they are to the centroids of their own language."""
    for b in batches:
        of_lang = {}
        for lang, at, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            of_lang.setdefault(lang, []).append((np.frombuffer(at, np.uint16), np.frombuffer(n, np.uint32)))
        for lang in of_lang.keys() & centres.keys():
            for lo in range(0, len(of_lang[lang]), ROUND_STEP):
                some = of_lang[lang][lo:lo + ROUND_STEP]
                own = np.zeros((len(some), BUCKETS), np.float32)
                for i, (at, n) in enumerate(some):
                    own[i, at] = np.sqrt(n.astype(np.int64)) * idf[at]
                own = normalised(own)
                yield lang, own, own @ centres[lang].T


def next_round(rows: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The centroids after one more round over all ``lang, at, n`` of ``rows`` (``counted``)."""
    shared = rows.sparkSession.sparkContext.broadcast((idf, centres))

    def sums(batches):
        total = {}
        for lang, found, near in _by_language(batches, *shared.value):
            if lang not in total:
                total[lang] = np.zeros((len(shared.value[1][lang]), BUCKETS))
            mine = near.argmax(1)[None, :] == np.arange(near.shape[1])[:, None]
            total[lang] += mine.astype(np.float64) @ np.rint(found.astype(np.float64) * UNIT)
        keys = [(lang, j) for lang, x in total.items() for j in range(len(x)) if x[j].any()]
        yield {"lang": [k[0] for k in keys], "j": [k[1] for k in keys], "sums": [total[i][j].tobytes() for i, j in keys]}

    def add(group):
        import pandas as pd

        whole = sum(np.frombuffer(x, np.float64) for x in group["sums"])
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "j": group["j"].iloc[:1], "sums": [whole.tobytes()]})

    schema = "lang string, j int, sums binary"
    got = map_batches(rows.select("lang", "at", "n"), sums, schema).groupBy("lang", "j").applyInPandas(add, schema).collect()
    out = {lang: c.copy() for lang, c in centres.items()}      # a centroid without rows stays
    for r in got:
        out[r["lang"]][r["j"]] = unit(np.frombuffer(r["sums"], np.float64)[None] / UNIT)[0]
    return out


def limits(rows: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray]) -> dict[str, float]:
    """Per language the similarity below which a text is rejected, from all ``lang, at, n`` of ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast((idf, centres))

    def bins(batches):
        for lang, _, near in _by_language(batches, *shared.value):
            at, n = np.unique(np.rint(near.max(1).astype(np.float64) * BINS).astype(np.int64), return_counts=True)
            yield {"lang": [lang] * len(at), "bin": at, "n": n}

    # At most BINS + 1 rows per language, however many texts there are.
    binned = map_batches(rows.select("lang", "at", "n"), bins, "lang string, bin long, n long").groupBy("lang", "bin").agg(
        F.sum("n").alias("n"))
    of_lang = Window.partitionBy("lang")
    place = (F.sum("n").over(of_lang) - 1) * REJECT_QUANTILE
    upto = of_lang.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = binned.select("lang", "bin", "n", F.sum("n").over(upto).alias("upto"), place.alias("place"))
    near = placed.filter((F.col("upto") > F.floor("place")) & (F.col("upto") - F.col("n") <= F.ceil("place"))).collect()
    out = {}
    for lang in {r["lang"] for r in near}:
        own = sorted((r["bin"], r["upto"], r["place"]) for r in near if r["lang"] == lang)
        at = own[0][2]
        low, high = (next(b for b, upto, _ in own if upto > place) for place in (np.floor(at), np.ceil(at)))
        out[lang] = REJECT_PART * (low + (high - low) * (at - np.floor(at))) / BINS
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            langs, scores, rejected = model.predict(b.column(2).to_pylist())
            yield {"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": langs, "score": scores,
                   "rejected": rejected}

    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            _, _, rejected = model.predict(b.column(at).cast(pa.string()).to_pylist())
            yield b.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
