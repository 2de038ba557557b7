"""What one user has seen and clicked before each impression."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import gap_bucket, smoothed_rate
from lagwise.operators import ranges
from lagwise.operators.history import join_combination
from lagwise.sources.layers import staged

_USER = "_user"


def _wrapped(config: Config) -> Column:
    """The user in a struct, so that rows without a user are a user like any other."""
    return F.struct(F.col(config.columns.user).alias("id"))


def hot_users(df: DataFrame, config: Config = Config()) -> DataFrame:
    """(_user, n): users with more rows than one task should order, at most rows / ``hot_user_rows``."""
    return (df.groupBy(_wrapped(config).alias(_USER)).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > config.hot_user_rows))


def hot_ranges(df: DataFrame, hot: DataFrame, config: Config = Config()) -> DataFrame:
    """The rows of ``hot`` users in ranges of (user, time, ties), written.

    Cuts follow the rows: a second with a million rows is as many ranges as any other million rows,
    and no range is much longer than ``hot_user_rows``. If that is less than a task should have, a task
    has many ranges: there are as many tasks as its rows ask for, however short the ranges are.
    """
    c = config.columns
    rows = hot.agg(F.sum("n")).first()[0] or 0
    order = [F.col(name).asc_nulls_first() for name in (c.user, c.time, c.ad, c.slot, c.row_id)]
    some = df.withColumn(_USER, _wrapped(config)).join(hot.select(_USER), _USER, "left_semi")
    per_range = max(1, config.hot_user_rows)
    dealt = ranges.dealt(some, order, ranges.range_count(df, rows, per_range), "hot-rows")
    return ranges.sliced(dealt, order, per_range, "hot-ranges")


def _earlier_ranges(rows: DataFrame, config: Config) -> DataFrame:
    """Per hot user and range: what had happened before the range began."""
    c = config.columns
    totals = rows.filter(F.col(c.time).isNotNull()).groupBy(_USER, ranges.PART).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c.label).alias("k"), F.max(c.time).alias("last"))
    before = (Window.partitionBy(_USER).orderBy(ranges.PART)  # at most one row per range
              .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(
        _USER, ranges.PART, F.sum("n").over(before).alias("_n0"),
        F.sum("k").over(before).alias("_k0"), F.max("last").over(before).alias("_last0"))


def _within(df: DataFrame, keys: list[str], config: Config) -> DataFrame:
    """Position, earlier clicks and previous time inside each window partition.

    Rows without a time are a partition of their own: no row comes after them. Rows that tie on
    the whole order have no earlier and later, so none of them counts the clicks of the others;
    their window needs no shuffle or sort of its own.
    """
    c = config.columns
    ties = [c.time, c.ad, c.slot, c.row_id]
    keys = [*keys, F.col(c.time).isNull()]
    order = Window.partitionBy(*keys).orderBy(*ties)
    tied = Window.partitionBy(*keys, *ties).orderBy(*ties)
    rows = (Window.unboundedPreceding, -1)
    zero, label = F.lit(0), F.sum(c.label)
    return df.withColumns({
        "_n1": F.row_number().over(order).cast("bigint"),
        "_k1": F.coalesce(label.over(order.rowsBetween(*rows)), zero)
        - F.coalesce(label.over(tied.rowsBetween(*rows)), zero),
        "_last1": F.lag(c.time).over(order)})


def _only_dated(features: dict[str, Column], config: Config) -> dict[str, Column]:
    """NULL on rows without a time."""
    return {k: F.when(F.col(config.columns.time).isNotNull(), v) for k, v in features.items()}


def with_user_order(df: DataFrame, config: Config = Config(),
                    history_of: DataFrame | None = None) -> DataFrame:
    """Add ``order_seen`` (1 for a user's first row), ``gap_sec`` and ``clk_prev``.

    A running window puts a whole user into one task, which is right for nearly all of them. The rows
    of the few with very many are written in ranges of the window's order and scanned twice: inside
    each range, and over the totals of the ranges before it. The result is that of the window over
    the whole user. ``df`` is then read once for the hot users and once for the others.

    ``history_of`` is the table to count users in, if ``df`` is the same rows behind costly joins.
    """
    c, source = config.columns, df if history_of is None else history_of
    hot = staged(hot_users(source, config), "hot-users")
    plain = {"order_seen": F.col("_n1"), "clk_prev": F.col("_k1"),
             "gap_sec": F.col(c.time) - F.col("_last1")}
    inner = ["_n1", "_k1", "_last1"]
    if hot.isEmpty():
        return _within(df, [c.user], config).withColumns(_only_dated(plain, config)).drop(*inner)
    others = df.withColumn(_USER, _wrapped(config)).join(hot.select(_USER), _USER, "left_anti")
    others = _within(others.drop(_USER), [c.user], config).withColumns(_only_dated(plain, config))
    rows = hot_ranges(df, hot, config)
    joined = _within(rows, [_USER, ranges.PART], config).join(
        staged(_earlier_ranges(rows, config), "range-totals"), [_USER, ranges.PART], "left")
    zero = F.lit(0)
    carried = joined.withColumns(_only_dated({
        "order_seen": F.col("_n1") + F.coalesce("_n0", zero),
        "clk_prev": F.col("_k1") + F.coalesce("_k0", zero),
        "gap_sec": F.col(c.time) - F.coalesce("_last1", "_last0")}, config))
    return others.drop(*inner).unionByName(
        carried.drop(*inner, _USER, ranges.PART, "_n0", "_k0", "_last0"))


def _lagged_totals(df: DataFrame, lag_days: int, config: Config) -> DataFrame:
    """Per user and day: impressions and clicks up to ``lag_days`` days earlier."""
    c = config.columns
    daily = df.filter(F.col(c.day).isNotNull()).groupBy(c.user, c.day).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c.label).alias("k"))
    day_number = F.unix_date(c.day).cast("bigint")
    before = (Window.partitionBy(c.user).orderBy(day_number)
              .rangeBetween(Window.unboundedPreceding, -lag_days))
    return daily.select(c.user, c.day, F.sum("n").over(before).alias("_n_lag"),
                        F.sum("k").over(before).alias("_k_lag"))


def with_user_fatigue(df: DataFrame, config: Config = Config(), lag_days: int = 0,
                      history_of: DataFrame | None = None) -> DataFrame:
    """User features on every row of ``df``, which carries ``p0``.

    By default the user's rate uses every earlier row. With ``lag_days`` it uses only whole days
    at least that far back, for outcomes that become known late.
    """
    c = config.columns
    source = df if history_of is None else history_of
    ordered = with_user_order(df, config, source)
    seen, clicked = F.col("order_seen") - 1, F.col("clk_prev")
    if lag_days > 0:
        ordered = join_combination(ordered, _lagged_totals(source, lag_days, config),
                                   [c.user, c.day])  # rows without a user are a user, too
        seen, clicked = (F.coalesce("_n_lag", F.lit(0)), F.coalesce("_k_lag", F.lit(0)))
    featured = ordered.withColumns({
        "ctr_user_prev": smoothed_rate(clicked, seen, F.col("p0"), config.user_prior_weight),
        "log_imp_prev": F.log1p((F.col("order_seen") - 1).cast("double")),
        "gap_bucket": gap_bucket(F.col("gap_sec")),
        "log_gap": F.log1p(F.coalesce("gap_sec", F.lit(0)).cast("double")),
        "order_capped": F.least("order_seen", F.lit(config.order_cap)).cast("double"),
    })
    return featured.drop("_n_lag", "_k_lag")
