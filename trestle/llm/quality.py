"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document.  The ledger keeps what was measured and one bit per failed rule; a policy
is a named, versioned set of rules, so applying it is one bit mask, and comparing policies or leaving one rule out
needs no text.  Only DataFrame functions are used: counts over arrays of a row, no explode and no shuffle, so a
document of any length stays one row and no key can be hot.

Words are runs of anything but space and the characters 0x09 to 0x0D.  ``n_repeat_words`` counts the words inside
8-word windows that occur at least twice in the text; the windows are compared by a 64-bit hash, sorted with their
positions, and the union of the flagged windows is measured from gap to gap, so the work is n log n for n words.

Defined cases: a null or empty text has no words, all its counts are 0 and it fails ``too_few_words``; a null id is
kept as null; repeated rows are judged each on its own; columns besides id and text are ignored by ``ledger`` and
passed through by ``keep``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import texts

WINDOW = 8
_WORD_GAP = "[ \\t-\\r]+"
_SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Bit positions: a rule keeps its place for ever, new rules are added at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > word_chars"),
    ("duplicate_lines", "n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines"),
    ("word_length_low", "word_chars < 2 * n_words"),
    ("word_length_high", "word_chars > 40 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = ("too_few_words", "repeated_windows")

#: policy version -> rules that reject
POLICIES: Mapping[str, Sequence[str]] = {
    "base-1": BASE,
    "strict-1": (*BASE, "symbols", "duplicate_lines", "word_length_low", "word_length_high"),
}
DEFAULT_POLICY = "strict-1"


def mask(policy: str | Sequence[str]) -> int:
    return sum(BIT[r] for r in set(POLICIES[policy] if isinstance(policy, str) else policy))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs at least twice; ``hashes`` holds one hash per window."""
    at = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    twice = _let(F.sort_array(at), lambda s: F.filter(
        s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(places, start, lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])


def measure(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the measurements of :data:`MEASURES` (named with ``prefix``) for the column ``text``."""
    p = prefix
    words, lines, hashes = f"{p}_words_", f"{p}_lines_", f"{p}_hashes_"
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.withColumns({
        words: F.filter(F.split(body, _WORD_GAP), lambda w: w != ""),
        lines: F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
    })
    df = df.withColumn(hashes, F.when(F.size(words) >= WINDOW, _let(F.col(words), lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))))))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return df.withColumns({
        f"{p}n_words": F.size(words).cast("long"),
        f"{p}word_chars": F.length(F.array_join(words, "")).cast("long"),
        f"{p}n_symbols": F.regexp_count(body, F.lit(_SYMBOLS)).cast("long"),
        f"{p}n_lines": F.size(lines).cast("long"),
        f"{p}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        f"{p}n_repeat_words": F.when(some, _repeat_words(F.col(hashes))).otherwise(F.lit(0).cast("long")),
    }).drop(words, lines, hashes)


def _failures(prefix: str = "") -> Column:
    """The failure bits, from the measured columns."""
    bits = F.lit(0).cast("long")
    for name, failed in RULES:
        for m in sorted(MEASURES, key=len, reverse=True) if prefix else ():
            failed = failed.replace(m, f"{prefix}{m}")
        bits = bits + F.when(F.expr(failed), F.lit(BIT[name]).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failures`` (one bit per rule of :data:`RULES`)."""
    return measure(texts(docs, id_col, text_col)).drop("text").withColumn("failures", _failures())


def failed(policy: str | Sequence[str], failures: str | Column = "failures") -> Column:
    """True where a document breaks a rule of ``policy``."""
    c = F.col(failures) if isinstance(failures, str) else failures
    return c.bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def keep(docs: DataFrame, policy: str | Sequence[str] = DEFAULT_POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with their own columns; the measurements take names of their own."""
    p = "_trestle_quality_"
    own = [F.col(f"`{c}`") for c in docs.columns]
    # Generated, not projected: a filter on a projected column is pushed below it and measures everything again.
    rows = measure(docs, text_col, p).select(*own, F.explode(F.array(_failures(p))).alias(f"{p}failures"))
    return rows.filter(~failed(policy, f"{p}failures")).select(*own)


def ablation(rows: DataFrame, policies: Sequence[str] = tuple(POLICIES)) -> DataFrame:
    """Per policy and rule: documents that fail the rule, and those that only this rule of the policy rejects.

    The ledger is first counted per distinct failure pattern, of which there are at most 2^rules.
    """
    patterns = rows.groupBy("failures").agg(F.count("*").alias("n"))
    parts = [(p, r, mask(p), BIT[r]) for p in policies for r in POLICIES[p]]
    cases = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                                         F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit"))
                                for p, r, m, b in parts])).alias("c")
    hit = F.col("failures").bitwiseAND(F.col("c.mask"))
    return (patterns.select("failures", "n", cases)
            .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
            .agg(F.sum(F.when(hit.bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(hit == F.col("c.bit"), F.col("n")).otherwise(0)).alias("n_only_this")))
