"""Joining impressions with their ad and user dimensions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.functions.columns import flag


def with_ads(impressions: DataFrame, ads: DataFrame, config: Config = Config()) -> DataFrame:
    """Inner join on the ad id.

    No hint: the ad table grows with the catalogue, so the planner's size threshold chooses
    between a broadcast and a sort-merge join whose skewed partitions AQE splits.
    """
    return impressions.join(ads, on=config.columns.ad, how="inner")


def with_profiles(impressions: DataFrame, profiles: DataFrame,
                  config: Config = Config()) -> DataFrame:
    """Left join on the user id; users without a profile stay and are flagged."""
    marker = config.profile_columns[0]
    return (impressions.join(profiles, on=config.columns.user, how="left")
            .withColumn("no_profile", flag(F.col(marker).isNull())))


def sentinel(column: str) -> Column:
    return F.coalesce(F.col(column).cast("int"), F.lit(fv.SENTINEL))


def fill_sentinel(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """NULL becomes the sentinel in every listed column, in one projection."""
    return df.withColumns({c: sentinel(c) for c in columns})


def with_ad_flags(df: DataFrame, config: Config = Config()) -> DataFrame:
    return df.withColumns({
        "brand_known": flag(F.col("brand").isNotNull()),
        "price_valid": flag(F.col(config.columns.price) > 0),
    })


def enriched(impressions: DataFrame, ads: DataFrame, profiles: DataFrame,
             config: Config = Config()) -> DataFrame:
    """Ad and profile columns on every impression, with flags, before any NULL is filled.

    The raw brand and the label's complement are dropped: one is a cast artefact, the other is
    the answer.
    """
    joined = with_profiles(with_ads(impressions, ads, config), profiles, config)
    return with_ad_flags(joined, config).drop("brand", "nonclk", "ts_utc_s")


def silver_table(impressions: DataFrame, ads: DataFrame, profiles: DataFrame,
                 config: Config = Config()) -> DataFrame:
    """The enriched table with the sentinel in every profile column."""
    return fill_sentinel(enriched(impressions, ads, profiles, config), config.profile_columns)
