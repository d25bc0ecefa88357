"""Line deduplication by a deletion-neighbourhood join.

A line is its sequence of words (runs of anything but space and 0x09 to 0x0D).  Of equal lines with a word only the
earliest stays; a line of at least ``FUZZY`` words also goes if an earlier line of at least that many words differs from
it by one word changed, added or left out.  "Earlier" is by document, then line number, and also counts lines that go
themselves, so the result does not depend on any order of work.

A document is an id and a text: rows with the same id and different texts are different documents, in the order of the
MD5 of their texts.  The sum is only looked at where an id has several texts.

Every line is hashed once.  Two lines one word apart share their first or their last words up to the middle, so only
lines whose half is also the half of a different line emit variants: themselves and, for each place in the other half,
themselves without that word.  Variants meet by hash; in each group of equal variants only the earliest line is kept,
by an aggregate, so a group of any size costs one row per line and never a pair of its members.  What is left are pairs
of a line and one earlier witness, whose words are compared before the line is dropped.  Should the earliest witness
only have the same hash, all other lines that share a variant with the line are compared with it.

Only DataFrame functions are used.  Word places are hashed into sums over prefixes, so the variants of a line of n
words take n steps; lines of more than ``LONG`` words get their sums from a window over their words instead of an
array, which keeps the work of very long lines in proportion.

Defined cases: a null text has no lines; blank lines stay; an id that is null comes before all others; rows that
repeat an id and a text are one document, whose equal lines at the same place are not copies of each other; ``apply``
passes all columns through, and leaves out documents of which no line with a word is left although they had one; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trestle.llm.common import land

FUZZY, LONG = 8, 2048
_OTHER = "[\\t-\\r]"
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the key of the document, ``_trestle_key``: its id, and its text's sum if the id has several texts."""
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    digest = F.coalesce(F.md5(F.col(text_col).cast("string").cast("binary")), F.lit(""))
    several = docs.select(own.alias("_trestle_id"), digest.alias("x")).groupBy("_trestle_id").agg(
        F.min("x").alias("x"), F.max("x").alias("_trestle_several")).filter("x < _trestle_several").drop("x")
    rows = docs.join(land(several), own == F.col("_trestle_id"), "left")
    version = F.when(F.col("_trestle_several").isNotNull(), digest).otherwise("")
    return rows.withColumn("_trestle_key", F.struct(own.alias("id"), version.alias("version"))).drop(
        "_trestle_id", "_trestle_several")


def _texts(keyed: DataFrame, text_col: str) -> DataFrame:
    return keyed.select(F.col("_trestle_key").alias("doc"), F.col(text_col).cast("string").alias("text"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _words(line: Column) -> Column:
    """White space other than spaces is rare within a line, and splitting at one character is much cheaper."""
    spaced = F.when(line.rlike(_OTHER), F.regexp_replace(line, _OTHER, " ")).otherwise(line)
    return F.array_remove(F.split(spaced, " "), "")


def _half(side: int, n: Column, k: Column, words: Column) -> Column:
    start = F.lit(1) if side == 0 else n - k + 1
    return F.when(n >= FUZZY, F.xxhash64(F.lit(side), k, F.slice(words, start, k)))


def hashed_lines(texts: DataFrame) -> DataFrame:
    """One row per line: its place, number of words, hashes, and the hashes of its halves (for either length that a
    partner can have).  Blank lines are left out when the table is read, where the filter needs no second split."""
    rows = texts.select("doc", F.posexplode(_lines(F.col("text"))).alias("line", "text"))
    rows = rows.select("doc", "line", _words(F.col("text")).alias("words"))
    rows = rows.select("doc", "line", "words", F.size("words").alias("n"))
    n, words = F.col("n"), F.col("words")
    k, j = F.floor((n - 1) / 2).cast("int"), F.floor((n - 2) / 2).cast("int")
    other = k != j
    return rows.select(
        "doc", "line", "n", F.xxhash64("words").alias("h"), F.xxhash64(F.lit(77), "words").alias("g"),
        _half(0, n, k, words).alias("head"), F.when(other, _half(0, n, j, words)).alias("head_less"),
        _half(1, n, k, words).alias("end"), F.when(other, _half(1, n, j, words)).alias("end_less"))


def _place_hash(h: Column, place: Column, seed: int) -> Column:
    """40 bits, so that sums over millions of words stay within a long."""
    return F.shiftrightunsigned(F.xxhash64(h, place, F.lit(seed)), 24)


def _key(n: Column, by_place: Column, all_words: Column) -> Column:
    """Of a line of ``n`` words, by the sum of its words' hashes with and without their places."""
    return F.xxhash64(n, by_place, all_words)


def _word_hashes(w: Column, i: Column) -> list[Column]:
    """Of a word at place ``i`` (from 0): without its place, as it stands after a deletion before it, and what it has
    more at its own place."""
    h = F.xxhash64(w)
    moved = _place_hash(h, i, 1)
    return [_place_hash(h, F.lit(0), 2).alias("bag"), moved.alias("moved"), (_place_hash(h, i + 1, 1) - moved).alias("more")]


def _short_variants(lines: DataFrame) -> DataFrame:
    """``place, key`` per variant (place 0: the whole line) from an array of running sums."""
    zero = F.lit(0).cast("long")

    def total(field):
        return F.aggregate("x", zero, lambda acc, x: acc + x[field])

    lines = lines.withColumn("x", F.transform("words", lambda w, i: F.struct(*_word_hashes(w, i))))
    lines = lines.withColumns({
        "bag": total("bag"), "moved": total("moved"),
        "before": F.aggregate("x", F.array(zero), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, F.lit(-1)) + x["more"])))})
    n, given = F.col("n"), F.array(F.struct("x", "bag", "moved", "before"))

    def variants(g):
        whole = F.struct(F.lit(0).alias("place"),
                         _key(n, g["moved"] + F.element_at(g["before"], F.lit(-1)), g["bag"]).alias("key"))
        return F.concat(F.array(whole), F.transform(F.sequence("low", "high"), lambda i: F.struct(
            i.alias("place"), _key(n - 1, g["moved"] - g["x"][i - 1]["moved"] + g["before"][i - 1],
                                   g["bag"] - g["x"][i - 1]["bag"]).alias("key"))))

    return lines.select("h", "g", "doc", "line", F.explode(F.transform(given, variants)[0]).alias("v")).select(
        "h", "g", "doc", "line", "v.place", "v.key")


def _long_variants(lines: DataFrame) -> DataFrame:
    """The same from one row per word and a window over the words of a line."""
    rows = lines.select("h", "g", "doc", "line", "n", "low", "high", F.posexplode("words").alias("i", "w"))
    rows = rows.select("*", *_word_hashes(F.col("w"), F.col("i")))
    total = rows.groupBy("h", "g", "doc", "line", "n").agg(
        F.sum(F.col("moved") + F.col("more")).alias("s"), F.sum("bag").alias("bag")).select(
        "h", "g", "doc", "line", F.lit(0).alias("place"), _key(F.col("n"), F.col("s"), F.col("bag")).alias("key"))
    line = Window.partitionBy("h", "g").orderBy("i")
    before = F.sum("more").over(line.rowsBetween(Window.unboundedPreceding, -1))
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    some = rows.select("*", F.coalesce(before, F.lit(0)).alias("before"), F.sum("moved").over(every).alias("all_moved"),
                       F.sum("bag").over(every).alias("all_bag"))
    some = some.filter((F.col("i") + 1).between(F.col("low"), F.col("high"))).select(
        "h", "g", "doc", "line", (F.col("i") + 1).alias("place"),
        _key(F.col("n") - 1, F.col("all_moved") - F.col("moved") + F.col("before"),
             F.col("all_bag") - F.col("bag")).alias("key"))
    return total.union(some)


def _one_word_apart(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word changed, added or left out apart."""
    def same(x, y):
        differ = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False))
        return F.when(differ == 0, F.least(F.size(x), F.size(y))).otherwise(differ - 1)

    few, many = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return (many - few <= 1) & (same(a, b) + same(F.reverse(a), F.reverse(b)) >= many - 1)


def near_lines(texts: DataFrame, lines: DataFrame, classes: DataFrame, long_line: int = LONG) -> DataFrame:
    """``h, g`` of the classes of lines that an earlier line is one word away from."""
    halves = lines.filter(F.col("n") >= FUZZY).select("h", "g", F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(c).alias("half"))
        for c, side in (("head", 0), ("head_less", 0), ("end", 1), ("end_less", 1))])).alias("x"))
    halves = halves.select("h", "g", "x.side", "x.half").filter("half IS NOT NULL")
    shared = halves.groupBy("half").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x <> y").select("half")
    live = halves.join(shared, "half").groupBy("h", "g").agg(F.max(F.col("side") == 0).alias("by_head"),
                                                           F.max(F.col("side") == 1).alias("by_end"))
    live = classes.join(live, ["h", "g"])

    # The words of the lines that are left: one row per document goes through the join, with its own lines, then one
    # per line.
    wanted = live.groupBy("doc").agg(F.collect_list(F.struct("line", "h", "g", "n", "by_head", "by_end")).alias("x"))
    found = texts.join(wanted, "doc").select("doc", F.explode(F.transform(F.array(_lines(F.col("text"))), lambda rows:
        F.transform("x", lambda x: F.struct(x.alias("x"), F.get(rows, x["line"]).alias("text"))))[0]).alias("y"))
    less = F.floor((F.col("n") - 2) / 2).cast("int")
    found = found.select("doc", "y.x.*", _words(F.col("y.text")).alias("words")).withColumns({
            "low": F.when(F.col("by_end"), F.lit(1)).otherwise(less + 1),
            "high": F.when(F.col("by_head"), F.col("n")).otherwise(F.col("n") - less)})
    found = land(found.dropDuplicates(["h", "g"]))

    variants = land(_short_variants(found.filter(F.col("n") <= long_line)).union(
        _long_variants(found.filter(F.col("n") > long_line))))
    place = F.struct("doc", "line")
    by_place = variants.groupBy("key", "place").agg(F.min(place).alias("first"), F.count("*").alias("m"))
    by_key = by_place.groupBy("key").agg(
        F.min(F.when(F.col("place") == 0, F.col("first"))).alias("whole"),
        F.min(F.when(F.col("place") > 0, F.col("first"))).alias("cut"), F.sum("m").alias("all"))
    by_key = by_key.filter(F.col("all") > 1).drop("all")
    met = variants.join(by_key, "key").join(by_place.drop("m"), ["key", "place"])
    # One word changed: the same place left out.  One word more or less: a whole line against a shortened one.
    witness = F.least(F.col("first"), F.when(F.col("place") == 0, F.col("cut")).otherwise(F.col("whole")))
    pairs = met.withColumn("witness", witness).filter(F.col("witness") < place).groupBy("h", "g").agg(
        F.min("witness").alias("witness")).select("h", "g", "witness.doc", "witness.line")
    mine = found.select("h", "g", "words")
    other = found.select("doc", "line", F.col("words").alias("earlier"))
    tried = land(pairs.join(mine, ["h", "g"]).join(other, ["doc", "line"]).select(
        "h", "g", _one_word_apart(F.col("words"), F.col("earlier")).alias("near")))
    near, failed = tried.filter("near").select("h", "g"), tried.filter("NOT near").select("h", "g")
    return near if failed.isEmpty() else near.union(_other_witnesses(variants, failed, mine, other))


def _other_witnesses(variants: DataFrame, failed: DataFrame, mine: DataFrame, other: DataFrame) -> DataFrame:
    """``h, g`` of the ``failed`` classes that any earlier line with an equal variant is one word away from."""
    own = variants.join(failed, ["h", "g"]).alias("m")
    every = variants.select("key", "place", "doc", "line").alias("o")
    meet = own.join(every, F.expr("m.key = o.key AND (m.place = o.place OR m.place = 0 OR o.place = 0)"
                                  " AND struct(o.doc, o.line) < struct(m.doc, m.line)"))
    meet = meet.select("m.h", "m.g", "o.doc", "o.line").distinct()
    return meet.join(mine, ["h", "g"]).join(other, ["doc", "line"]).filter(
        _one_word_apart(F.col("words"), F.col("earlier"))).select("h", "g").distinct()


def _gone(keyed: DataFrame, text_col: str, long_line: int) -> DataFrame:
    """``doc, dropped``: the numbers (from 0, ascending) of the lines that go, per document that loses any."""
    texts = _texts(keyed, text_col)
    lines = land(hashed_lines(texts)).filter("n > 0")
    classes = land(lines.groupBy("h", "g").agg(F.min(F.struct("doc", "line")).alias("first"),
                                               F.count("*").alias("m"), F.first("n").alias("n")))
    places = classes.select("h", "g", "n", "first.doc", "first.line")
    near = land(near_lines(texts, lines, places.filter(F.col("n") >= FUZZY), long_line))
    near = near.withColumn("near", F.lit(True))
    judged = classes.join(near, ["h", "g"], "left").filter("m > 1 OR near").select(
        "h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("h", "g", "doc", "line").join(judged, ["h", "g"]).filter(
        F.col("near") | (F.struct("doc", "line") != F.col("first")))
    return gone.groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("dropped"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_line: int = LONG) -> DataFrame:
    """``doc`` (``id``, ``version``) and ``dropped``: the numbers (from 0, ascending) of the lines that go."""
    return _gone(_keyed(docs, id_col, text_col), text_col, long_line)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_kept, dropped`` for every row of ``docs``."""
    keyed = _keyed(docs.select(id_col, text_col), id_col, text_col)
    rows = keyed.select(F.col(id_col).cast("long").alias("doc_id"), F.col("_trestle_key").alias("doc"),
                        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(_lines(F.col(text_col)))).alias("n_lines"))
    gone = rows.join(_gone(keyed, text_col, LONG), "doc", "left")
    none = F.array().cast("array<int>")
    return gone.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                       (F.col("n_lines") - F.size(F.coalesce("dropped", none))).cast("long").alias("n_kept"),
                       F.coalesce("dropped", none).alias("dropped"))


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the lines taken out of the text (and ``length_col``, if there is one, counted anew)."""
    keyed = _keyed(docs, id_col, text_col)
    gone = _gone(keyed, text_col, LONG).withColumnsRenamed({"doc": "_trestle_doc", "dropped": "_trestle_gone"})
    rows = keyed.join(gone, F.col("_trestle_key") == F.col("_trestle_doc"), "left")
    lines = _lines(F.col(text_col))
    left = F.transform(F.array(lines), lambda x: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), "_trestle_gone"), lambda i: F.get(x, i)))[0]
    changed = F.col("_trestle_gone").isNotNull()
    rows = rows.withColumn("_trestle_text", F.when(changed, F.array_join(left, "\n")).otherwise(F.col(text_col)))
    rows = rows.filter(~changed | F.col("_trestle_text").rlike("[^ \\t-\\r]"))
    new = {text_col: F.col("_trestle_text")}
    if length_col in docs.columns:
        new[length_col] = F.when(changed, F.length("_trestle_text")).otherwise(F.col(length_col)).cast(
            docs.schema[length_col].dataType)
    return rows.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
