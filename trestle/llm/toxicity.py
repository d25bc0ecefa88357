"""Toxicity by a convolutional text classifier trained in numpy.

A word is embedded as the sum of hashed rows: one for the word and some for its first and last letters, so unseen
forms of a known stem are near to it.  Filters of one, two and three words run over the whole text; the largest value
of each filter feeds a logistic output.

The classifier is fitted on all distinct labelled rows whose crc32(id) mod 3 is not 1.  It starts on the driver with few
of them (``training_rows``: about ``SAMPLE`` of each label, at most twice as many and ``SAMPLE_CHARS`` characters).  If
there are more, ``PASSES`` passes over all of them follow: every task goes on from the common model with its own rows,
and the steps of the tasks are averaged, those of an embedding row by how often a task moved it.  A fifth of the rows are
kept from the training; all of those fit the scale of the score and a threshold per language.

Scores come from the text alone.  The language column is used only to pick a threshold for ``flagged``; ``predicted``
is the score against 0.7 in every language.

Defined cases: null and empty texts get the score of an empty text; documents without a label are scored like others;
different labels of one document count as rows of their own; without training rows every score is 0; repeated rows are
scored each on its own; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trestle.llm.common import is_held_out, land, map_batches

ROWS, DIM = 1 << 16, 16                  # hashed embedding table
WIDTHS, FILTERS = (1, 2, 3), 8           # filters per width
SAMPLE, SAMPLE_CHARS = 4000, 30_000_000  # bounds of the rows with which the training starts, per label
BITS, MAX_BITS = 8, 1 << 26              # of the filter of labelled ids: for each, and in all (a million rows)
PASSES = 2                               # over all training rows, if there are more than those
SLICES, STEPS = 64, 1000                 # parts of the embedding that are averaged apart; steps of a logit in the cuts
EPOCHS, BATCH, RATE, SEED = 12, 16, 0.15, 17
DROP = 0.4                               # share of a text's words that a training step leaves out
CUT = 0.7                                # score from which a text is predicted to be toxic
MAX_WORDS = 200_000                      # a worker's table of known words; a full table is emptied

_PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum() and c != 0x27)
_SPACED = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACED).split()


def features(word: bytes) -> tuple[int, ...]:
    """Rows of the embedding table: the whole word, its first 3, 4, 5 and its last 3, 4, 5 characters."""
    if word.isascii():                  # a byte is a character
        a, b, c, x, y, z = word[:3], word[:4], word[:5], word[-3:], word[-4:], word[-5:]
    else:
        w = word.decode("utf-8", "replace")
        a, b, c, x, y, z = (p.encode() for p in (w[:3], w[:4], w[:5], w[-3:], w[-4:], w[-5:]))
    h, most = xxhash.xxh32_intdigest, ROWS - 1      # written out: most of the work on texts is new words
    return (h(b"=" + word) & most, h(b"<" + a) & most, h(b"<" + b) & most, h(b"<" + c) & most,
            h(x + b">") & most, h(y + b">") & most, h(z + b">") & most)


N_FEATURES = len(features(b"a"))


class Vocabulary(dict):
    """Word -> number; the features of each number.  Number 0 is the padding."""

    def __init__(self):
        super().__init__()
        self.rows = array("i")      # the features of the words met since it was last emptied, one after another

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        self.rows.extend(features(word))
        return n

    def numbers(self, text: str | None) -> np.ndarray:
        """Word numbers of a text between paddings, so that it has at least one place for every filter."""
        found = words(text)
        out = np.zeros(max(3, len(found) + 2), np.int32)
        out[1:len(found) + 1] = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        return out


@dataclass
class Model:
    embedding: np.ndarray                 # ROWS x DIM
    filters: list[np.ndarray]             # per width: width x DIM x FILTERS
    biases: np.ndarray                    # filters in order of the widths
    weights: np.ndarray
    bias: float
    slope: float = 1.0                    # of the calibrated score
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    trained: bool = False

    def taps(self, rows: array) -> np.ndarray:
        """What each word adds to each place of each filter: one row per word."""
        e = self.embedding[np.array(rows, np.int32).reshape(-1, N_FEATURES)].sum(1)
        return np.concatenate([e @ f[k] for f in self.filters for k in range(len(f))], axis=1)

    def logit(self, taps: np.ndarray) -> float:
        """Output for the tap rows of a text's word numbers."""
        out, at = [], 0
        for f in self.filters:
            n = len(taps) - len(f) + 1
            total = taps[:n, at:at + FILTERS].copy()
            for k in range(1, len(f)):
                total += taps[k:k + n, at + k * FILTERS:at + (k + 1) * FILTERS]
            out.append(total.max(0))
            at += len(f) * FILTERS
        return float(np.maximum(np.concatenate(out) + self.biases, 0) @ self.weights + self.bias)

    def score(self, logit: float) -> float:
        if not self.trained:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -40, 40))))


class Scorer:
    """Scores texts with a bounded table of known words."""

    def __init__(self, model: Model):
        self.model, self.known = model, None

    def __call__(self, text: str | None) -> float:
        m = self.model
        if self.known is None or len(self.known) > MAX_WORDS:
            self.known, self.table, self.filled = Vocabulary(), None, 1
        numbers = self.known.numbers(text)
        if self.table is None or len(self.known) + 1 > len(self.table):
            width = sum(len(f) for f in m.filters) * FILTERS
            grown = np.zeros((max(4096, 2 * (len(self.known) + 1)), width), np.float32)
            if self.table is not None:
                grown[:self.filled] = self.table[:self.filled]
            self.table = grown
        if self.known.rows:
            got = m.taps(self.known.rows)
            self.table[self.filled:self.filled + len(got)] = got
            self.filled += len(got)
            del self.known.rows[:]
        return m.score(m.logit(self.table[numbers]))


class Training:
    """A model in training, with the sums of its squared gradients."""

    def __init__(self, model: Model):
        self.model = model
        self.squares = {"bias": np.zeros_like(model.biases), "weights": np.zeros_like(model.weights),
                        **{j: np.zeros_like(f) for j, f in enumerate(model.filters)}}
        self.embedding_squares = np.zeros(ROWS, np.float32)

    def _step(self, name, value, grad):
        s = self.squares[name]
        s += grad * grad
        value -= RATE * grad / (np.sqrt(s) + 1e-6)

    def dense(self) -> list[np.ndarray]:
        """All arrays but for the embedding's."""
        return [*self.model.filters, self.model.biases, self.model.weights, *self.squares.values()]

    def epochs(self, texts: list[str], labels: np.ndarray, use: np.ndarray, rng, n: int, hits: np.ndarray | None = None):
        """Train ``n`` times on the texts numbered in ``use``; ``hits`` counts the moves of each embedding row."""
        m, n_out = self.model, len(WIDTHS) * FILTERS
        vocabulary = Vocabulary()
        numbers = [vocabulary.numbers(t) for t in texts]
        rows = np.concatenate([np.zeros((1, N_FEATURES), np.int32), np.array(vocabulary.rows, np.int32).reshape(-1, N_FEATURES)])
        used = np.ones((len(rows), 1), np.float32)
        used[0] = 0                                             # the padding adds nothing
        for _ in range(n):
            rng.shuffle(use)
            for lo in range(0, len(use), BATCH):
                g_filters = [np.zeros_like(f) for f in m.filters]
                g_bias, g_weights, g_out = np.zeros(n_out, np.float32), np.zeros(n_out, np.float32), 0.0
                places, gradients = [], []
                batch = use[lo:lo + BATCH]
                for i in batch:
                    w = numbers[i]
                    w = np.concatenate(([0], w[rng.random(len(w)) >= DROP], [0, 0]))    # no single word may be enough
                    own, back = np.unique(w, return_inverse=True)
                    x = (m.embedding[rows[own]].sum(1) * used[own])[back]
                    best, top = [], []
                    for f in m.filters:
                        k_places = len(w) - len(f) + 1
                        y = sum(x[k:k + k_places] @ f[k] for k in range(len(f)))
                        best.append(y.argmax(0))
                        top.append(y.max(0))
                    value = np.concatenate(top) + m.biases
                    active = value > 0
                    pooled = np.where(active, value, 0)
                    d = 1 / (1 + np.exp(-np.clip(pooled @ m.weights + m.bias, -40, 40))) - labels[i]
                    g_out += d
                    g_weights += d * pooled
                    dv = d * m.weights * active
                    g_bias += dv
                    for j, f in enumerate(m.filters):
                        dj = dv[j * FILTERS:(j + 1) * FILTERS]
                        for k in range(len(f)):
                            at = best[j] + k
                            g_filters[j][k] += x[at].T * dj
                            places.append(w[at])
                            gradients.append(f[k].T * dj[:, None])
                scale = 1 / len(batch)
                self._step("bias", m.biases, g_bias * scale)
                self._step("weights", m.weights, g_weights * scale + 1e-4 * m.weights)
                m.bias -= 0.02 * g_out * scale
                for j, f in enumerate(m.filters):
                    self._step(j, f, g_filters[j] * scale + 1e-4 * f)
                at, grad = np.concatenate(places), np.concatenate(gradients) * scale
                real = at > 0
                hit, where = np.unique(rows[at[real]], return_inverse=True)
                total = np.zeros((len(hit), DIM), np.float32)
                np.add.at(total, where.reshape(-1), np.repeat(grad[real], N_FEATURES, axis=0))
                self.embedding_squares[hit] += (total * total).mean(1)
                m.embedding[hit] -= RATE * total / (np.sqrt(self.embedding_squares[hit])[:, None] + 1e-6)
                if hits is not None:
                    hits[hit] += 1


def train(texts: list[str], labels: np.ndarray, langs: list[str | None], held: np.ndarray) -> Training:
    """Fit the network on the rows that are not ``held``, then the score's scale and the thresholds on those."""
    rng = np.random.default_rng(SEED)
    n_out = len(WIDTHS) * FILTERS
    m = Model(rng.normal(0, 0.1, (ROWS, DIM)).astype(np.float32),
              [rng.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
              np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out).astype(np.float32), 0.0)
    t = Training(m)
    if not len(texts) or labels.min() == labels.max():
        return t
    t.epochs(texts, labels, np.flatnonzero(~held), rng, EPOCHS)
    m.trained = True
    scorer = Scorer(m)
    test = np.flatnonzero(held) if held.any() and labels[held].min() < labels[held].max() else np.arange(len(texts))
    raw = np.array([_raw(m, scorer(texts[i])) for i in test])
    _calibrate(m, raw, labels[test], np.ones(len(test), np.int64), [langs[i] for i in test])
    return t


def _raw(m: Model, score: float) -> float:
    """The logit before the score's scale."""
    s = np.clip(score, 1e-9, 1 - 1e-9)
    return (np.log(s / (1 - s)) - m.shift) / m.slope


def _calibrate(m: Model, raw: np.ndarray, labels: np.ndarray, times: np.ndarray, langs: list[str | None]) -> None:
    """Shift the score so that its best cut is ``CUT``, and find the best cut of every language; entry i counts
    ``times[i]`` times."""
    def best_cut(values, truth, n):
        order = np.argsort(values)
        v, t, n = values[order], truth[order], n[order]
        errors = np.concatenate(([0], np.cumsum(n * t))) + np.concatenate((np.cumsum((n * (1 - t))[::-1])[::-1], [0]))
        least = np.flatnonzero(errors == errors.min())
        k = int(least[len(least) // 2])                     # cut below the k-th value
        return float((v[max(k - 1, 0)] + v[min(k, len(v) - 1)]) / 2)

    target = float(np.log(CUT / (1 - CUT)))
    cut = best_cut(raw, labels, times)
    m.slope, m.shift, m.thresholds = 1.0, target - cut, {}
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        if labels[own].min() < labels[own].max():
            m.thresholds[lang] = m.score(best_cut(raw[own], labels[own], times[own]))


def is_kept(ids) -> np.ndarray:
    """Which rows are kept from the training, for the score's scale."""
    return np.array([xxhash.xxh32_intdigest(str(i)) % 5 == 0 for i in ids], bool)


def all_training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "toxic", lang_col: str | None = "lang") -> DataFrame:
    """``_id, text, lang, label``: all distinct labelled texts that are not held out, landed."""
    rows, marks = _rows_and_marks(docs, labels, id_col, text_col, label_col, lang_col)
    marks = land(marks.distinct())
    found = likely(rows.filter(~is_held_out("_id")), marks).join(marks, "_id").select("_id", "text", "lang", "label").distinct()
    # In an order that has nothing to do with the label, and is the same on each run.
    return land(found.sortWithinPartitions(F.xxhash64("_id", "text", F.lit(5)), "_id", "label", "lang"))


def likely(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``_id`` is not in ``marks``, so that their texts are not shuffled to the join.

    Every id of ``marks`` sets the bit of its hash, about ``BITS`` bits an id, in a broadcast table of 64 bits a row."""
    if rows.schema["_id"].dataType != marks.schema["_id"].dataType:
        return rows                                           # the join compares other values than those
    words = min(MAX_BITS, max(64, BITS * marks.count())) // 64

    def place(part: str):
        return F.expr(f"pmod(xxhash64(_id, 6), {64 * words}L) {part}")

    bits = marks.groupBy(place("div 64").alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place("% 64").cast("int"))).alias("_bits"))
    return rows.withColumn("_word", place("div 64")).join(F.broadcast(bits), "_word").filter(
        F.getbit("_bits", place("% 64").cast("int")) == 1).drop("_word", "_bits")


def one_pass(rows: DataFrame, t: Training, number: int) -> None:
    """Train ``t`` once on all ``_id, text, lang, label`` of ``rows`` that are not kept for the score's scale."""
    shared = rows.sparkSession.sparkContext.broadcast(t)      # a fixed size
    size = ROWS // SLICES

    def run(batches):
        from copy import deepcopy

        start, own, hits, n = shared.value, deepcopy(shared.value), np.zeros(ROWS, np.int64), 0
        task = TaskContext.get().partitionId()
        rng = np.random.default_rng([SEED, number, task])
        for b in batches:
            use = np.flatnonzero(~is_kept(b.column(0).to_pylist()))
            texts, labels = b.column(1).take(use).to_pylist(), np.array(b.column(3).take(use).to_pylist(), np.float32)
            own.epochs(texts, labels, np.arange(len(texts)), rng, 1, hits)
            n += len(texts)
        out = {"slice": [], "task": [], "n": [], "rows": [], "steps": []}

        def add(*values):
            for c, v in zip(out.values(), values, strict=True):
                c.append(v)

        if n:
            steps = [x.astype(np.float64).ravel() - y.ravel() for x, y in zip(own.dense(), start.dense(), strict=True)]
            add(-1, task, n, b"", np.concatenate([*steps, [own.model.bias - start.model.bias]]).tobytes())
        for k in range(SLICES):
            at = k * size + np.flatnonzero(hits[k * size:(k + 1) * size])
            if len(at):
                add(k, task, n, np.stack([at, hits[at]]).tobytes(), np.column_stack([
                    own.model.embedding[at] - start.model.embedding[at],
                    own.embedding_squares[at] - start.embedding_squares[at]]).astype(np.float32).tobytes())
        yield out

    def mean(group):
        import pandas as pd

        group, k = group.sort_values("task"), int(group["slice"].iloc[0])
        if k < 0:
            weights = group["n"].to_numpy()
            total = sum(n * np.frombuffer(x, np.float64) for n, x in zip(weights, group["steps"]))
            return pd.DataFrame({"slice": [k], "rows": [b""], "steps": [(total / weights.sum()).tobytes()]})
        total, weights = np.zeros((size, DIM + 1)), np.zeros(size)
        for r, x in zip(group["rows"], group["steps"]):
            at, n = np.frombuffer(r, np.int64).reshape(2, -1)
            total[at - k * size] += n[:, None] * np.frombuffer(x, np.float32).reshape(-1, DIM + 1)
            weights[at - k * size] += n
        hit = np.flatnonzero(weights)
        return pd.DataFrame({"slice": [k], "rows": [(hit + k * size).tobytes()],
                             "steps": [(total[hit] / weights[hit, None]).tobytes()]})

    moved = map_batches(rows.select("_id", "text", "lang", "label"), run,
                        "slice int, task int, n long, rows binary, steps binary")
    for r in moved.groupBy("slice").applyInPandas(mean, "slice int, rows binary, steps binary").collect():    # the model
        steps = np.frombuffer(r["steps"], np.float64)
        if r["slice"] < 0:
            lo = 0
            for x in t.dense():
                x += steps[lo:lo + x.size].reshape(x.shape).astype(x.dtype)
                lo += x.size
            t.model.bias += float(steps[lo])
        else:
            at, steps = np.frombuffer(r["rows"], np.int64), steps.reshape(-1, DIM + 1)
            t.model.embedding[at] += steps[:, :DIM].astype(np.float32)
            t.embedding_squares[at] += steps[:, DIM].astype(np.float32)


def calibrate(rows: DataFrame, m: Model) -> None:
    """Fit the score's scale and the thresholds on all rows that are kept from the training (on all rows, if those have
    one label only).  Logits are counted in steps of 1 / ``STEPS``."""
    shared = rows.sparkSession.sparkContext.broadcast(m)

    def logits(batches, every: bool):
        scorer, m = Scorer(shared.value), shared.value
        for b in batches:
            use = np.flatnonzero(is_kept(b.column(0).to_pylist()) | every)
            at = [round(_raw(m, scorer(t)) * STEPS) for t in b.column(1).take(use).to_pylist()]
            yield {"lang": b.column(2).take(use), "label": b.column(3).take(use), "at": at}

    for every in (False, True):
        found = map_batches(rows.select("_id", "text", "lang", "label"), lambda x, every=every: logits(x, every),
                            "lang string, label int, at long").groupBy("lang", "label", "at").count().collect()
        if len({r["label"] for r in found}) == 2:
            found.sort(key=lambda r: (r["at"], r["label"], str(r["lang"])))
            _calibrate(m, np.array([r["at"] / STEPS for r in found]), np.array([r["label"] for r in found], np.float64),
                       np.array([r["count"] for r in found]), [r["lang"] for r in found])
            return


def _rows_and_marks(docs, labels, id_col, text_col, label_col, lang_col):
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       lang.alias("lang"))
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & ~is_held_out("_id"))
    return rows, marks


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", lang_col: str | None = "lang", sample: int = SAMPLE,
                  sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``_id, text, lang, label`` with which the training starts: distinct labelled texts, per label at most ``2 * sample``
    of them and ``sample_chars`` characters (longer texts only come in the passes over all rows).

    Ids are drawn from the labels, so that only texts of chosen ids are moved.  An id may stand on very many rows: what
    it brings is thinned again by a hash of id and text, and made distinct by an aggregate, before a label's rows meet.
    """
    rows, marks = _rows_and_marks(docs, labels, id_col, text_col, label_col, lang_col)

    def parts(df):
        """Rows and characters per label, at most two rows."""
        return {r["label"]: (r["n"], r["chars"]) for r in df.groupBy("label").agg(
            F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()}

    def share(found, of):
        out = F.lit(0.0)
        for label, counted in found.items():
            out = F.when(F.col("label") == label, F.lit(of(*counted))).otherwise(out)
        return out

    # The sample's share is found from the labels alone; only chosen rows meet their texts.
    first = parts(marks.withColumn("chars", F.lit(0)))
    marks = land(marks.distinct().filter(
        F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1_000_000)) / 1e6 < share(first, lambda n, _: min(1.0, sample / n))))
    # About ``sample`` ids per label are a small table; texts are not shuffled for them.
    few = F.broadcast(marks) if marks.count() <= 4 * sample else marks
    chosen = land(rows.join(few, "_id").filter(F.length("text") <= sample_chars).select("_id", "text", "lang", "label"))
    found = parts(chosen.withColumn("chars", F.length("text")))
    draw = F.xxhash64("_id", "text", F.lit(4))
    part = share(found, lambda n, chars: min(1.0, 1.5 * sample / n, sample_chars / max(chars, 1)))
    thin = chosen.filter(F.pmod(draw, F.lit(1_000_000)) / 1e6 < part).distinct()
    of_label = Window.partitionBy("label").orderBy(draw, "_id", "text", "lang")
    return thin.select("*", F.row_number().over(of_label).alias("k"), F.sum(F.length("text")).over(
        of_label.rowsBetween(Window.unboundedPreceding, 0)).alias("chars")).filter(
        (F.col("k") <= 2 * sample) & (F.col("chars") <= sample_chars)).drop("k", "chars")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        lang_col: str | None = "lang", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    got = training_rows(docs, labels, id_col, text_col, label_col, lang_col, sample, sample_chars)
    got = sorted(got.collect(), key=lambda r: (r["_id"], r["label"], r["text"], str(r["lang"])))
    t = train([r["text"] for r in got], np.array([r["label"] for r in got], np.float32), [r["lang"] for r in got],
              is_kept(r["_id"] for r in got))
    rows = all_training_rows(docs, labels, id_col, text_col, label_col, lang_col)
    if t.model.trained and rows.count() > len(got):
        for number in range(PASSES):
            one_pass(rows, t, number)
        calibrate(rows, t.model)
    return t.model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = "lang") -> DataFrame:
    """``doc_id, held_out, score, predicted, flagged`` of every whole text."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a fixed size: the embedding table

    def run(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            got = [scorer(t) for t in b.column(2).to_pylist()]
            cuts = [shared.value.thresholds.get(x, CUT) for x in b.column(3).to_pylist()]
            yield {"doc_id": b.column(0), "held_out": b.column(1), "score": got,
                   "predicted": [int(s >= CUT) for s in got], "flagged": [s >= c for s, c in zip(got, cuts)]}

    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int, flagged boolean")
