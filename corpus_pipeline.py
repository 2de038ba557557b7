"""The corpus pipeline: five stages, each on all that the stage before kept.

Language ID, exact dedup, near-dedup, secret scan, packing. Each stage is written as Parquet and
read again as the next one's documents; all but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagwise.llm import exact, language, near, packing, secrets
from lagwise.llm.common import documents
from lagwise.llm.tokens import tokenizer
from lagwise.sources.layers import staged


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, and texts whose words no language explains."""
    return language.keep_identified(docs, language.train(docs.select("doc_id", "text", "lang")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the largest id of each group of equal texts."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that near-duplicate links connect."""
    return near.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each secret in a text is replaced by a mark."""
    return secrets.redacted(docs, length_col="n_chars")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence, with its token ids."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_windows),
]

#: SQL has no tokenizer and no trained field: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
