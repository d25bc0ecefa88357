"""From raw documents to packed training sequences: five stages, each one operator of ``trestle.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trestle.llm import langid, line_dedup, lsh_forest, packing, quality
from trestle.llm.common import land, share_code, table

TOKENIZER = "byte_bpe_50k.json"
KNOWN_CHUNKS = 100_000   # workers are shared with the stages before, so their tables are kept smaller than by default


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or far from every language that the corpus has, go.  The languages are learned from all
    rows; ``fit``'s ``sample`` only bounds where its rounds start."""
    share_code(spark)
    return langid.keep(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule of the default policy go."""
    share_code(spark)
    return quality.keep(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go; so do documents of which nothing is left."""
    share_code(spark)
    return line_dedup.apply(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, similarity 0.8)."""
    share_code(spark)
    return lsh_forest.keep(docs, size=5, threshold=80)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 2048 tokens."""
    share_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), max_chunks=KNOWN_CHUNKS)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("packing", packed_sequences),
]

#: Language ID, MinHash and tokens have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(share_code(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir))
    return docs
