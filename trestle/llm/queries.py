"""The registered queries of this package: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trestle.llm.common import share_code, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(share_code(spark), sf_dir)
    return fn


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trestle.llm import bpe

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from trestle.llm import quality

    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       quality.failed("base-1").alias("base_failed"),
                       (~quality.failed(quality.DEFAULT_POLICY)).alias("kept"), F.col("n_lines"), F.col("failures"))


ORACLE_SQL["op8_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, r, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, words[i : i + 7] AS w8 FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), twice AS (
  SELECT r, unnest(places) AS i
  FROM (SELECT r, w8, list(i) AS places FROM windows GROUP BY r, w8 HAVING count(*) > 1)
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
              + 4 * (10 * n_symbols > word_chars)::INT + 8 * (n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines)::INT
              + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 40 * n_words)::INT AS BIGINT) AS failures
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failures = 0 AS kept, n_lines,
       failures
FROM f
"""


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trestle.llm import packing

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import langid

    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from trestle.llm import token_store

    store = token_store.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    keys = spark.read.parquet(f"{store.root}/entries").select("doc_id", "copy")
    return token_store.read_digests(spark, store, token_store.lookup(spark, store, keys))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


#: The rules of the registered query.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import url_filter

    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


ORACLE_SQL["op5_url_filter"] = """
WITH rules(rule, verdict) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'),
         ('com/de/', 'block')
), r AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules
), p AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), hit AS (
  SELECT n, rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, rule DESC) AS k
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN hit ON p.n = hit.n AND k = 1
"""


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import lsh_forest

    return lsh_forest.groups(table(spark, sf_dir, "documents"), size=4, threshold=80)


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from trestle.llm import line_dedup

    rows = line_dedup.report(table(spark, sf_dir, "documents"))
    return rows.withColumn("dropped", F.array_join(F.col("dropped").cast("array<string>"), ","))


ORACLE_SQL["op4_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, text, struct_pack(id := coalesce(doc_id, -9223372036854775808), sum := coalesce(md5(text), '')) AS doc
  FROM documents
), l AS (
  SELECT doc, unnest(range(len(lines))) AS line, unnest(lines) AS s
  FROM (SELECT doc, string_split(text, chr(10)) AS lines FROM d WHERE text IS NOT NULL)
), w AS (
  SELECT doc, line, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS words FROM l
), c AS (
  SELECT words, len(words) AS n, min(struct_pack(d := doc, l := line)) AS first
  FROM w WHERE len(words) > 0 GROUP BY words
), v AS (
  SELECT words, n, first, i, list_concat(words[1 : i - 1], words[i + 1 : n]) AS rest
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM c WHERE n >= 8)
), changed AS (
  SELECT words FROM (SELECT words, first, min(first) OVER (PARTITION BY rest, i) AS earliest FROM v)
  WHERE first > earliest
), longer AS (
  SELECT v.words AS more, v.first AS f_more, c.words AS less, c.first AS f_less
  FROM v JOIN c ON v.rest = c.words WHERE c.n >= 8
), near AS (
  SELECT words FROM changed
  UNION SELECT more FROM longer WHERE f_more > f_less
  UNION SELECT less FROM longer WHERE f_less > f_more
), gone AS (
  SELECT w.doc, list_sort(list(DISTINCT w.line)) AS dropped
  FROM w JOIN c ON w.words = c.words LEFT JOIN near ON near.words = w.words
  WHERE near.words IS NOT NULL OR struct_pack(d := w.doc, l := w.line) <> c.first
  GROUP BY w.doc
)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(len(dropped), 0) AS BIGINT) AS n_kept,
       coalesce(array_to_string(dropped, ','), '') AS dropped
FROM d LEFT JOIN gone ON d.doc = gone.doc
"""


@query
def op1_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import ann

    return ann.search(table(spark, sf_dir, "embeddings"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import simhash

    return simhash.groups(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trestle.llm import repair

    return repair.report(table(spark, sf_dir, "conversations"))
