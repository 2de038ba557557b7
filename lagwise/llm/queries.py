"""The queries of this subpackage: each applies one operator to the whole of ``documents``."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lagwise.llm import (bpe, exact, language, lines, lm, merkle, near, negatives, packing, quality, rans,
                         secrets, sentencepieces)
from lagwise.llm.common import documents
from lagwise.llm.tokens import tokenizer


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.decide(documents(spark, sf_dir))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out_scores(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rans.write_corpus(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return rans.read_corpus(spark, path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.roundtrip(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_secrets, op2_near_dedup, op3_lm_scoring, op4_quality, op5_line_dedup, op6_packing,
        op7_exact_dedup, op8_language_id, op9_bpe, op10_token_files, op11_hard_negatives,
        op12_sentencepieces, op13_merkle)}
