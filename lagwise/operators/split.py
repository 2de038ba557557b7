"""Splitting by time, and the per-day summary of the split."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.functions.columns import ratio


def _between(config: Config, start, end) -> Column:
    return F.col(config.columns.day).between(F.lit(start), F.lit(end))


def in_train(config: Config = Config()) -> Column:
    return _between(config, config.splits.train_start, config.splits.train_end)


def in_val(config: Config = Config()) -> Column:
    return _between(config, config.splits.val_start, config.splits.val_end)


def in_test(config: Config = Config()) -> Column:
    return _between(config, config.splits.test_start, config.splits.test_end)


def split_label(config: Config = Config()) -> Column:
    return (F.when(F.col(config.columns.day) == F.lit(config.splits.burn_in), fv.SPLIT_BURN_IN)
            .when(in_train(config), fv.SPLIT_TRAIN)
            .when(in_val(config), fv.SPLIT_VAL)
            .when(in_test(config), fv.SPLIT_TEST)
            .otherwise(fv.SPLIT_OUTSIDE))


def temporal_split(df: DataFrame, config: Config = Config()
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, test), each a filter on the day alone, so it prunes partitions.

    The burn-in day is in none of them.
    """
    return df.filter(in_train(config)), df.filter(in_val(config)), df.filter(in_test(config))


def split_summary(df: DataFrame, config: Config = Config()) -> DataFrame:
    day = config.columns.day
    per_day = df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"),
                                  F.sum(config.columns.label).alias("positives"))
    return per_day.select(
        day, "rows", "positives",
        F.round(100 * ratio(F.col("positives"), F.col("rows")), 6).alias("ctr_pct"),
        split_label(config).alias("split"))
