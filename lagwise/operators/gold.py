"""The feature table: every impression with 12 categorical and 19 numeric features."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.operators.fatigue import with_user_fatigue
from lagwise.operators.history import (category_price, combination_keys, entity_features,
                                       join_combination, price_columns, with_slot_rate)
from lagwise.sources.layers import staged


def gold_columns(config: Config = Config()) -> list[str]:
    """Ids (not features, but needed to audit a row), day, label and features, without repeats."""
    c = config.columns
    ids = [c.row_id, c.user, c.ad, c.category, *config.entities, c.time, c.day, c.label]
    return list(dict.fromkeys([*ids, *config.categorical, *config.numeric]))


def gold_features(silver: DataFrame, config: Config = Config(), origin: int | None = None,
                  lag_days: int = 0) -> DataFrame:
    """All features of the silver table, one row per impression.

    The wide table is shuffled once for the user windows. It meets the per-combination features
    (entity histories, prior and category price, joined among themselves beforehand) and the
    slot rates in one join each; both are staged, so each is broadcast if its real size allows.
    """
    category = config.columns.category
    features, prices = entity_features(silver, config), category_price(silver, config)
    if category in config.entities:
        features = features.join(prices, category, "left")
        rows = silver
    else:
        rows = silver.join(staged(prices, "category-price"), category, "left")
    rows = join_combination(rows, staged(features, "entity-features"), combination_keys(config))
    rows = with_slot_rate(rows, history_of=silver, origin=origin, config=config)
    rows = with_user_fatigue(rows, config, lag_days, history_of=silver)
    rows = rows.withColumns(price_columns(config))
    return rows.withColumn("hour", F.col("hour").cast("int")).select(*gold_columns(config))
