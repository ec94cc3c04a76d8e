"""The corpus pipeline: documents go through the stages in order, each over all rows that the one before kept.

Every stage's rows are written to the shared folder and read again, so a lost executor costs one stage at most. A null
text is an empty one, a row without id is compared with no other and stays, and further columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constituent360.llm import bpe, language_id, line_dedup, minhash, mixing
from constituent360.llm.common import fresh, stored, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a null lang is filled in."""
    return language_id.recognised(docs, language_id.trained(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id already holds."""
    counts = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), "text", *counts)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (a similarity of 0.8 or more)."""
    return minhash.representatives(docs, 80, 100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the same bytes."""
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.tokenized(docs, vocabulary, ("doc_id", "lang", "source"))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: SQL can't state the first stage's model; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
