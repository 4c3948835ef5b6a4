"""A corpus pipeline: language ID, line dedup, near-dedup, decontamination, byte-level BPE.

Every stage but the last returns the columns of documents; n_chars follows the text where a stage changes it.
Rows without doc_id and rows that share one are documents of their own: no stage drops or multiplies them for that.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlake.llm import bpe, decontamination, langid, linededup, near_texts, queries
from editlake.llm.util import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` with a number of its own for every row (key), written so that it stays."""
    return materialize(docs.select(COLUMNS).withColumn("key", F.monotonically_increasing_id()), label)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages learned from all of ``docs``: those that score as documents do in their own language and
    hardly any does in another. Those without a letter are rejected."""
    docs = docs.select(COLUMNS)
    profiles = materialize(langid.learn_profiles(docs), "language-profiles")
    return langid.identify_rows(docs, profiles, langid.learn_floors(docs, profiles))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that other documents have too; documents of which nothing but white space is left go."""
    rows = linededup.line_dedup(docs, carry=("lang", "source")).withColumnRenamed("kept", "text")
    rows = rows.filter(F.length(F.btrim("text", F.lit(linededup.BLANKS))) > 0)
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that of least doc_id, rows without doc_id coming last.

    Near-duplicates have a similarity of 0.8 or more on five-word shingles, directly or by others. Rows that share a doc_id are
    documents of their own; of those that could stay the one of least text hash does.
    """
    rows = numbered(docs, "near-dedup-rows")
    groups = near_texts.near_texts(rows, id_col="key").select(F.col("doc_id").alias("key"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "key")
    first = rows.select("doc_id", "key", F.xxhash64("text").alias("hash")).join(groups, "key")
    first = first.groupBy("component_id").agg(F.min(order).alias("first")).select("first.key")
    return rows.join(first, "key", "left_semi").select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows with a window of any benchmark item; each row goes by its own text, whatever its doc_id."""
    rows = numbered(docs, "decontamination-rows")
    marked = decontamination.mark_contamination(rows, queries.table(spark, sf_dir, "benchmark"), id_col="key")
    clean = marked.filter(F.size("hit_words") == 0).select(F.col("doc_id").alias("key"))
    return rows.join(clean, "key", "left_semi").select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with their digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_bpe(docs, path, public_tokenizers.PATTERN).drop("round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: Language profiles and SimHash components are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
