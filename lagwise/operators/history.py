"""Point-in-time rates: every value uses strictly earlier days (or hours) only."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import ratio, smoothed_rate
from lagwise.sources.layers import staged


#: Rows of a history that one task should hold at once; large tables are dealt to tasks by it.
TASK_ROWS = 100_000
_BUCKETS, _BUCKET = 1 << 16, "_bucket"


def _strictly_before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _dated(df: DataFrame, when: str) -> DataFrame:
    """Rows whose time did not parse are before nothing: they enter no history."""
    return df.filter(F.col(when).isNotNull())


def _hot_buckets(df: DataFrame, entity: str, rows: int) -> DataFrame | None:
    """Hash buckets of the entity with more rows than a task should hold, or None.

    An entity with that many rows is in one. Counting buckets takes a map of fixed size in each
    task, whatever the number of entities is.
    """
    if rows <= TASK_ROWS:
        return None
    counts = df.groupBy(F.pmod(F.xxhash64(entity), F.lit(_BUCKETS)).alias(_BUCKET)).agg(
        F.count(F.lit(1)).alias("n"))
    hot = staged(counts.filter(F.col("n") > TASK_ROWS).select(_BUCKET), "hot-buckets")
    return None if hot.isEmpty() else hot


def _parted(df: DataFrame, entity: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of hot buckets, and all others."""
    at = df.withColumn(_BUCKET, F.pmod(F.xxhash64(entity), F.lit(_BUCKETS)))
    return tuple(at.join(hot, _BUCKET, how).drop(_BUCKET) for how in ("left_semi", "left_anti"))


def _dealt(df: DataFrame, entity: str, rows: int) -> DataFrame:
    """``df`` by entity, to as many tasks as ``rows`` ask for; to the session's number if that is enough."""
    tasks = math.ceil(rows / TASK_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, entity) if tasks > usual else df


def daily_totals(df: DataFrame, keys: Sequence[str], config: Config = Config(),
                 rows: int = 0) -> DataFrame:
    """Impressions and clicks per key combination; partial sums meet in the shuffle.

    ``rows``, if given, says how many rows ``df`` has. If there are many, they are dealt by the first
    key to tasks of about ``TASK_ROWS``, as the sums of a task are held at once: then sums by day and
    histories need no other shuffle. Only keys that are too large for a task are summed before that.
    """
    if rows > TASK_ROWS:
        units = df.select(*keys, F.lit(1).alias("imp"), F.col(config.columns.label).alias("clk"))
        hot = _hot_buckets(units, keys[0], rows)
        sums = [F.sum("imp").alias("imp"), F.sum("clk").alias("clk")]
        if hot is not None:
            large, units = _parted(units, keys[0], hot)
            units = units.unionByName(large.groupBy(*keys).agg(*sums))
        return _dealt(units, keys[0], rows).groupBy(*keys).agg(*sums)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("imp"),
                                 F.sum(config.columns.label).alias("clk"))


def daily_ctr(df: DataFrame, config: Config = Config()) -> DataFrame:
    day = config.columns.day
    return daily_totals(df, [day], config).select(
        day, F.col("imp").alias("impressions"), F.col("clk").alias("clicks"),
        F.round(100 * ratio(F.col("clk"), F.col("imp")), 6).alias("ctr_pct")).orderBy(day)


def deferred_prior(daily: DataFrame, config: Config = Config()) -> DataFrame:
    """Click rate of all earlier days, per day; NULL on the first one.

    ``daily`` holds impressions and clicks at any grain that includes the day. The window runs
    over one row per calendar day, which is all its single task ever sees.
    """
    day = config.columns.day
    per_day = _dated(daily, day).groupBy(day).agg(F.sum("imp").alias("imp"),
                                                  F.sum("clk").alias("clk"))
    before = _strictly_before(Window.orderBy(day))
    return per_day.select(
        day, ratio(F.sum("clk").over(before), F.sum("imp").over(before)).alias("p0"))


def entity_history(daily: DataFrame, entity: str, config: Config = Config()) -> DataFrame:
    """Impressions and clicks of all earlier days per (entity, day).

    Summed to one row per entity and day before the window, so the longest window partition has
    as many rows as there are days, whatever share of the impressions the entity holds.
    """
    day = config.columns.day
    per_day = _dated(daily, day).groupBy(entity, day).agg(F.sum("imp").alias("imp"),
                                                          F.sum("clk").alias("clk"))
    before = _strictly_before(Window.partitionBy(entity).orderBy(day))
    return per_day.select(
        entity, day,
        F.coalesce(F.sum("imp").over(before), F.lit(0)).alias("imp_prev"),
        F.coalesce(F.sum("clk").over(before), F.lit(0)).alias("clk_prev"))


def _rate_columns(entity: str, imp: Column, clk: Column, p0: Column,
                  config: Config) -> dict[str, Column]:
    return {f"ctr_hist_{entity}": smoothed_rate(clk, imp, p0, config.entity_prior_weight),
            f"log_imp_hist_{entity}": F.log1p(imp.cast("double"))}


def _history_features(rows: DataFrame, totals_of: DataFrame, config: Config,
                      counts: bool) -> DataFrame:
    """``rows`` with ``p0`` and the features of every entity, from the totals of ``totals_of``.

    ``totals_of`` holds impressions and clicks at a grain that includes the entities and the day.
    """
    day = config.columns.day
    for e in config.entities:
        h = entity_history(totals_of, e, config).withColumnsRenamed(
            {"imp_prev": f"imp_prev_{e}", "clk_prev": f"clk_prev_{e}"})
        rows = rows.join(h, [e, day], "left")
    prior = deferred_prior(totals_of, config)
    return _with_rates(rows.join(F.broadcast(prior), day, "left"), config, counts)  # one row per day


def _with_rates(rows: DataFrame, config: Config, counts: bool) -> DataFrame:
    """The features of every entity, from the sums of earlier days; ``counts`` keeps these."""
    features: dict[str, Column] = {}
    for e in config.entities:
        features |= _rate_columns(e, F.col(f"imp_prev_{e}"), F.col(f"clk_prev_{e}"),
                                  F.col("p0"), config)
    raw = [] if counts else [f"{k}_prev_{e}" for e in config.entities for k in ("imp", "clk")]
    return rows.withColumns(features).drop(*raw)


def _with_running_history(df: DataFrame, entity: str, rows: int, config: Config) -> DataFrame:
    """``df`` with impressions and clicks of its entity on earlier days, by a window over the rows.

    The rows are shuffled once and no history is joined to them, but for entities with more rows than
    a task should hold: they get theirs from :func:`entity_history`.
    """
    day, label = config.columns.day, config.columns.label
    imp, clk = f"imp_prev_{entity}", f"clk_prev_{entity}"
    hot = _hot_buckets(df, entity, rows)
    large, usual = (None, df) if hot is None else _parted(staged(df, "history-rows"), entity, hot)
    before = (Window.partitionBy(entity).orderBy(F.unix_date(day).cast("bigint"))
              .rangeBetween(Window.unboundedPreceding, -1))
    known, dated = F.col(entity).isNotNull() & F.col(day).isNotNull(), F.col(day).isNotNull()

    def earlier(value: Column) -> Column:
        total = F.sum(F.when(dated, value)).over(before)
        return F.when(known, F.coalesce(total, F.lit(0)))

    out = _dealt(usual, entity, rows).withColumns(
        {imp: earlier(F.lit(1)), clk: earlier(F.col(label))})
    if large is None:
        return out
    units = large.select(entity, day, F.lit(1).alias("imp"), F.col(label).alias("clk"))
    history = entity_history(units, entity, config).withColumnsRenamed(
        {"imp_prev": imp, "clk_prev": clk})
    return out.unionByName(large.join(history, [entity, day], "left"))


def combination_keys(config: Config = Config()) -> list[str]:
    return list(dict.fromkeys([*config.entities, config.columns.day]))


def entity_features(df: DataFrame, config: Config = Config(),
                    counts: bool = False) -> DataFrame:
    """Rate and volume features for every combination of entities and day seen in ``df``.

    The histories meet here, on the aggregated combinations, and not on the impressions: the
    wide table is joined once for all entities. The combinations are staged, so all histories
    and the prior come from one pass over the impressions. ``counts`` keeps the raw sums.
    """
    combos = staged(daily_totals(df, combination_keys(config), config), "combinations")
    return _history_features(combos, combos, config, counts).drop("imp", "clk")


def join_combination(df: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the whole key combination, where a NULL key matches a NULL key."""
    renamed = features.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(renamed, on, "left").drop(*[f"_{k}" for k in keys])


def with_entity_history(df: DataFrame, config: Config = Config(), counts: bool = False,
                        combined: bool = True) -> DataFrame:
    """Every impression with the leak-free history features of all its entities, and ``p0``.

    ``combined`` joins the impressions once, with the features of each entity combination; the
    table of combinations is staged, so its real size decides whether it is broadcast. If nearly
    every impression is a combination of its own, that table saves nothing: then each entity's
    history comes from the impressions directly.
    """
    if combined:
        features = staged(entity_features(df, config, counts), "entity-features")
        return join_combination(df, features, combination_keys(config))
    n, day, rows = df.count(), config.columns.day, df
    for e in config.entities:
        rows = _with_running_history(rows, e, n, config)
    prior = deferred_prior(daily_totals(df, [day], config), config)
    return _with_rates(rows.join(F.broadcast(prior), day, "left"), config, counts)  # one row per day


def deferred_entity_ctr(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Long form: one row per impression and entity kind."""
    wide = with_entity_history(df, config, counts=True)
    return wide.select(config.columns.row_id, F.inline(F.array(*[
        F.struct(F.lit(e).alias("entity"),
                 F.col(f"imp_prev_{e}").alias("imp_prev"),
                 F.col(f"clk_prev_{e}").alias("clk_prev"),
                 F.round(f"ctr_hist_{e}", 6).alias("ctr_hist"),
                 F.round(f"log_imp_hist_{e}", 6).alias("log_imp_hist"))
        for e in config.entities])))


# --- moving rate of the slot ----------------------------------------------------------------------

def hour_index(df: DataFrame, origin: int | None = None, config: Config = Config()) -> Column:
    """Whole hours since ``origin`` (epoch seconds), by default the earliest row of ``df``.

    The default stays inside the query as a scalar subquery; nothing is fetched first.
    """
    time = config.columns.time
    start = F.lit(origin) if origin is not None else df.agg(F.min(time)).scalar()
    return F.floor((F.col(time) - start) / 3600).cast("bigint")


def slot_hour_rates(df: DataFrame, origin: int | None = None,
                    config: Config = Config()) -> DataFrame:
    """Mean hourly click rate over the preceding hours, per slot and hour.

    RANGE, not ROWS: hours without traffic count as elapsed time. The current hour is excluded.
    """
    slot = config.columns.slot
    hours = df.withColumn("hour_idx", hour_index(df, origin, config))
    hourly = daily_totals(_dated(hours, "hour_idx"), [slot, "hour_idx"], config)
    window = Window.partitionBy(slot).orderBy("hour_idx").rangeBetween(-config.rolling_hours, -1)
    return hourly.select(slot, "hour_idx",
                         F.avg(ratio(F.col("clk"), F.col("imp"))).over(window).alias("ctr_6h"))


def with_slot_rate(df: DataFrame, history_of: DataFrame | None = None, origin: int | None = None,
                   config: Config = Config()) -> DataFrame:
    """Add ``hour_idx`` and ``ctr_6h``; hours without history take ``p0``, which ``df`` carries.

    The rates (slots x hours) are staged: they are broadcast if that is really small, and joined
    by a skew-aware shuffle if there are very many slots.
    """
    source = df if history_of is None else history_of
    rates = staged(slot_hour_rates(source, origin, config), "slot-hours")
    joined = (df.withColumn("hour_idx", hour_index(source, origin, config))
              .join(rates, [config.columns.slot, "hour_idx"], "left"))
    return joined.withColumn("ctr_6h", F.coalesce("ctr_6h", "p0"))


# --- price against its category -------------------------------------------------------------------

def category_price(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Mean price per category over the training days only."""
    c, s = config.columns, config.splits
    train = df.filter(F.col(c.day).between(F.lit(s.train_start), F.lit(s.train_end)))
    return train.groupBy(c.category).agg(F.avg(c.price).alias("category_price"))


def price_columns(config: Config = Config()) -> dict[str, Column]:
    """``log_price`` and ``price_rel``; an unknown category counts as normally priced."""
    price, reference = F.col(config.columns.price), F.col("category_price")
    return {"log_price": F.log1p(F.greatest(price, F.lit(0.0))),
            "price_rel": F.coalesce(F.when(reference > 0, price / reference), F.lit(1.0))}


def with_price_relative(df: DataFrame, config: Config = Config()) -> DataFrame:
    prices = staged(category_price(df, config), "category-price")
    joined = df.join(prices, config.columns.category, "left")
    return joined.withColumns(price_columns(config)).drop("category_price")
