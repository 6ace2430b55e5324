"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
what a stage returns as Parquet under ``spark.checkpoint.dir`` and hands what
it reads back to the next one. All stages but the last keep the columns of
``documents``.

Rows: a null text counts as empty and fails the quality rules, so later stages
get none in ``run``; on their own they keep such rows. Every stage decides by
row, also among rows that share a doc_id or have none; of rows with equal id
and text one is left. ``n_chars``, where there is one, is not recomputed when a
passage is cut out of a text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bpe, decontaminate, minhash, quality, repeats
from tideline.llm.scratch import Scratch
from tideline.sources.tables import load

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity 0.8 or more): the least id."""
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of documents with a smaller id; texts left empty go.

    A character of which a byte goes is dropped whole. Rows keep their other columns.
    """
    return repeats.cut_repeats(docs, length=50)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (judged by their text, so also those without an id)."""
    by_text = F.xxhash64(F.col("text"))
    found = decontaminate.contamination(docs.select(by_text.alias("doc_id"), "text"), load(spark, sf_dir, "benchmark"))
    leaks = found.where("not kept").select(F.col("doc_id").alias("_leak")).distinct()
    rows = docs.select(F.struct("*").alias("row"), by_text.alias("_text"))
    return rows.join(leaks, F.col("_text") == F.col("_leak"), "left_anti").select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup),
          ("decontamination", decontamination), ("encoding", encoding)]

ORACLE_SQL = None  # compression, tilings and merges are beyond SQL: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    keep = Scratch(spark, "pipeline").keep
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
