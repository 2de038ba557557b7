"""Class imbalance: undersampling, nested fractions and weights."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import count_where, in_fraction, ratio, unpivot_rows


def kept_in_sample(config: Config = Config(), rate: float | None = None) -> Column:
    """All positives, and the share ``rate`` of the negatives."""
    c = config.columns
    rate = config.negative_rate if rate is None else rate
    return (F.col(c.label) == 1) | (
        (F.col(c.label) == 0) & in_fraction(F.col(c.row_id), rate, config.seed, "negatives"))


def undersample_negatives(df: DataFrame, config: Config = Config(),
                          rate: float | None = None) -> DataFrame:
    """One filter over one scan; which rows stay does not depend on the partitioning."""
    return df.filter(kept_in_sample(config, rate))


def class_balance(df: DataFrame, config: Config = Config(),
                  rate: float | None = None) -> DataFrame:
    """One row: classes before and after undersampling, and the rate really kept.

    Recalibration needs the effective rate: the nominal one is off by the sampling noise.
    """
    c = config.columns
    counts = df.agg(
        count_where(F.col(c.label) == 1).alias("positives"),
        count_where(F.col(c.label) == 0).alias("negatives"),
        count_where((F.col(c.label) == 0) & kept_in_sample(config, rate)).alias("negatives_kept"))
    pos, neg, kept = F.col("positives"), F.col("negatives"), F.col("negatives_kept")
    return counts.select(
        "positives", "negatives", "negatives_kept", (pos + kept).alias("rows_kept"),
        F.round(F.coalesce(ratio(kept, neg), F.lit(1.0)), 6).alias("effective_rate"),
        F.round(ratio(pos, pos + kept), 6).alias("prevalence_sample"),
        F.round(ratio(pos, pos + neg), 6).alias("prevalence_real"))


def effective_rate(df: DataFrame, config: Config = Config(), rate: float | None = None) -> float:
    """Share of negatives kept, unrounded (one aggregate, one number)."""
    c = config.columns
    kept, negatives = df.agg(
        count_where((F.col(c.label) == 0) & kept_in_sample(config, rate)),
        count_where(F.col(c.label) == 0)).first()
    return kept / negatives if negatives else 1.0


def fraction_of(df: DataFrame, fraction: float, config: Config = Config(),
                purpose: str = "fraction") -> DataFrame:
    """A repeatable sample; give samples of samples different purposes."""
    return df.filter(in_fraction(F.col(config.columns.row_id), fraction, config.seed, purpose))


def nested_fractions(df: DataFrame, fractions: Sequence[float],
                     config: Config = Config()) -> DataFrame:
    """Rows and positives in each fraction, counted in one pass; smaller ones are subsets."""
    c = config.columns
    member = {f: in_fraction(F.col(c.row_id), f, config.seed, "fraction") for f in fractions}
    wide = df.agg(
        *[count_where(m).alias(f"n{i}") for i, m in enumerate(member.values())],
        *[count_where(m & (F.col(c.label) == 1)).alias(f"k{i}")
          for i, m in enumerate(member.values())])
    names = [f"{f:g}" for f in fractions]
    return wide.select(unpivot_rows(names, {
        "rows": [F.col(f"n{i}") for i in range(len(names))],
        "positives": [F.col(f"k{i}") for i in range(len(names))]}, "fraction"))


def positive_weight(df: DataFrame, config: Config = Config()) -> DataFrame:
    """One row, one column: negatives per positive (1 if there are no positives)."""
    label = F.col(config.columns.label)
    return df.agg(F.coalesce(ratio(count_where(label != 1), count_where(label == 1)),
                             F.lit(1.0)).alias("weight"))


def with_class_weights(df: DataFrame, config: Config = Config(),
                       column: str = "weight") -> DataFrame:
    weight = positive_weight(df, config).scalar()
    return df.withColumn(column, F.when(F.col(config.columns.label) == 1, weight)
                         .otherwise(F.lit(1.0)))
