"""Executable evidence that no feature has seen its own outcome."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.functions.columns import (correlation, count_where, ratio, smoothed_rate,
                                       unpivot_rows)
from lagwise.operators.history import combination_keys
from lagwise.operators.quality import require_all_ok
from lagwise.sources.layers import staged

_TOLERANCE = 1e-9


def feature_correlations(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """Correlation of every measured feature with the label, all in one aggregate.

    The burn-in day has no history and is left out; a NULL on either side leaves the pair out.
    """
    c, names = config.columns, config.measured_numeric
    rows = gold.filter(F.col(c.day) != F.lit(config.splits.burn_in))
    wide = rows.agg(*[correlation(F.col(n), F.col(c.label)).alias(n) for n in names])
    long = wide.select(unpivot_rows(names, {"r": [F.col(n) for n in names]}, "feature"))
    verdict = (F.when(F.col("r").isNull(), fv.NO_SPREAD)
               .when(F.abs("r") > config.max_abs_correlation, fv.LEAK).otherwise(fv.OK))
    return long.select("feature", F.round("r", 6).alias("r"), verdict.alias("verdict"))


def burn_in_nulls(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """Missing entity rates on the first day that is trained on; there must be none."""
    c, rates = config.columns, [f"ctr_hist_{e}" for e in config.entities]
    first = gold.filter(F.col(c.day) == F.lit(config.splits.train_start))
    wide = first.agg(F.count(F.lit(1)).alias("rows"),
                     *[count_where(F.col(n).isNull()).alias(n) for n in rates])
    long = wide.select("rows", unpivot_rows(rates, {"nulls": [F.col(n) for n in rates]}, "feature"))
    verdict = (F.when(F.col("rows") == 0, fv.NO_ROWS).when(F.col("nulls") == 0, fv.OK)
               .otherwise(fv.BURN_IN_TOO_SHORT))
    return long.select("feature", "nulls", verdict.alias("verdict"))


def rate_ranges(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """Smallest and largest value of every entity rate; a rate lies in (0, 1]."""
    rates = [f"ctr_hist_{e}" for e in config.entities]
    wide = gold.agg(*[F.min(n).alias(f"lo_{n}") for n in rates],
                    *[F.max(n).alias(f"hi_{n}") for n in rates])
    long = wide.select(unpivot_rows(rates, {
        "lowest": [F.col(f"lo_{n}") for n in rates],
        "highest": [F.col(f"hi_{n}") for n in rates]}, "feature"))
    wrong = F.coalesce((F.col("lowest") <= 0) | (F.col("highest") > 1), F.lit(False))
    return long.select("feature", F.round("lowest", 6).alias("lowest"),
                       F.round("highest", 6).alias("highest"),
                       F.when(F.col("lowest").isNull(), fv.NO_ROWS)
                       .when(wrong, fv.IMPOSSIBLE_VALUE).otherwise(fv.OK).alias("verdict"))


def recomputed_history(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """Compare every stored entity rate with one computed another way.

    Here the history is the running total up to and including the day, minus the day itself,
    on the small entity-day table; a window left open on the current row would show up. The
    feature table is read once, into a staged table of entity combinations.
    """
    c = config.columns
    keys = combination_keys(config)
    combos = staged(gold.filter(F.col(c.day).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("imp"), F.sum(c.label).alias("clk"),
        *[f(f"ctr_hist_{e}").alias(f"{f.__name__}_{e}")
          for e in config.entities for f in (F.min, F.max)]), "leak-combinations")
    up_to_day = Window.orderBy(c.day)
    days = combos.groupBy(c.day).agg(F.sum("imp").alias("i"), F.sum("clk").alias("k"))
    prior = days.select(c.day, ratio(F.sum("k").over(up_to_day) - F.col("k"),
                                     F.sum("i").over(up_to_day) - F.col("i")).alias("p0"))

    def one(e: str) -> DataFrame:
        up_to = Window.partitionBy(e).orderBy(c.day)
        per_day = combos.groupBy(e, c.day).agg(
            F.sum("imp").alias("i"), F.sum("clk").alias("k"),
            F.min(f"min_{e}").alias("lo"), F.max(f"max_{e}").alias("hi"))
        running = per_day.select(
            c.day, "lo", "hi",
            (F.sum("i").over(up_to) - F.col("i")).alias("imp_before"),
            (F.sum("k").over(up_to) - F.col("k")).alias("clk_before"))
        rated = running.join(F.broadcast(prior), c.day, "left").withColumn(
            "expected", smoothed_rate(F.col("clk_before"), F.col("imp_before"), F.col("p0"),
                                      config.entity_prior_weight))
        off = F.when(F.col("expected").isNull(), F.col("lo").isNotNull()).otherwise(
            F.coalesce((F.abs(F.col("lo") - F.col("expected")) > _TOLERANCE)
                       | (F.abs(F.col("hi") - F.col("expected")) > _TOLERANCE), F.lit(True)))
        return rated.agg(F.count(F.lit(1)).alias("rows_checked"),
                         count_where(off).alias("mismatches")).select(
            F.lit(e).alias("entity"), "rows_checked", "mismatches",
            F.when(F.col("mismatches") == 0, fv.OK).otherwise(fv.LEAK).alias("verdict"))

    return reduce(DataFrame.unionByName, [one(e) for e in config.entities])


def leak_checks(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """The four checks, one row per thing checked: ``check``, ``subject``, ``verdict``."""
    parts = (("correlation", feature_correlations(gold, config), "feature"),
             ("burn_in", burn_in_nulls(gold, config), "feature"),
             ("range", rate_ranges(gold, config), "feature"),
             ("recompute", recomputed_history(gold, config), "entity"))
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(check).alias("check"), F.col(subject).alias("subject"), "verdict")
        for check, df, subject in parts])


def require_leak_free(gold: DataFrame, config: Config = Config()) -> None:
    require_all_ok(leak_checks(gold, config), "leakage")
