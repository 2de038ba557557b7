"""Column expressions shared by the operators. All of them stay inside the JVM."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lagwise import fixed_values as fv

PROBABILITY_FLOOR = 1e-12
_HASH_HEX_DIGITS = 8


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_seconds(ts_ntz: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp, whatever the session zone is."""
    days = F.unix_date(F.to_date(ts_ntz)).cast("bigint")
    return days * 86400 + F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60 + F.second(ts_ntz)


def utc_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a zone-free UTC timestamp."""
    return F.timestamp_add("SECOND", seconds, _epoch())


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(hours)} HOURS")


def day_part(hour: Column) -> Column:
    *bounded, (last, _) = fv.DAY_PARTS
    chain = F
    for name, end in bounded:
        chain = chain.when(hour < end, name)
    return chain.otherwise(last)


def gap_bucket(gap_seconds: Column) -> Column:
    chain = F.when(gap_seconds.isNull(), fv.GAP_FIRST)
    for name, end in fv.GAP_BUCKETS:
        chain = chain.when(gap_seconds <= end, name)
    return chain.otherwise(fv.GAP_LAST)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def smoothed_rate(clicks: Column, impressions: Column, prior: Column, weight: float) -> Column:
    """m-estimate: with no history the rate is the prior itself; with no prior it is NULL."""
    m = F.lit(float(weight))
    return (clicks.cast("double") + m * prior) / (impressions.cast("double") + m)


def corrected_probability(sampled: Column, factor: Column | float) -> Column:
    """Multiply the odds; by the share of negatives kept, this undoes undersampling."""
    r = factor if isinstance(factor, Column) else F.lit(float(factor))
    return sampled * r / (sampled * r + 1.0 - sampled)


def clipped(probability: Column) -> Column:
    return F.least(F.greatest(probability, F.lit(PROBABILITY_FLOOR)),
                   F.lit(1 - PROBABILITY_FLOOR))


def log_loss(label: Column, probability: Column) -> Column:
    p, y = clipped(probability), label.cast("double")
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, on an empty denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def two_proportion_z(hits_a: Column, n_a: Column, hits_b: Column, n_b: Column) -> Column:
    """Pooled-variance z of the difference of two rates; NULL where it is undefined."""
    a, b = n_a.cast("double"), n_b.cast("double")
    pooled = F.try_divide((hits_a + hits_b).cast("double"), a + b)
    spread = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), a) + F.try_divide(F.lit(1.0), b))
    return F.try_divide(ratio(hits_a, n_a) - ratio(hits_b, n_b), F.sqrt(spread))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sample_draw(row_id: Column, seed: int, purpose: str) -> Column:
    """A row's draw: hexadecimal digits, even over their range, from its id and the purpose."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), row_id.cast("string")))
    return F.substring(digest, 1, _HASH_HEX_DIGITS)


def drawn(draw: str | Column, fraction: float) -> Column:
    """Whether a draw falls into a sample of this fraction; smaller samples lie in larger ones."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"a fraction lies in [0, 1], got {fraction}")
    if fraction == 1:
        return F.lit(True)
    limit = format(int(fraction * 16 ** _HASH_HEX_DIGITS), f"0{_HASH_HEX_DIGITS}x")
    return (F.col(draw) if isinstance(draw, str) else draw) < limit


def in_fraction(row_id: Column, fraction: float, seed: int, purpose: str) -> Column:
    """A repeatable Bernoulli draw per row.

    The row id decides, not the partition it is read in: a lost task redraws the same rows, any
    layout of the input gives the same sample, and a smaller fraction is a subset of a larger one.
    Draws of the same purpose are nested; draws of different purposes are independent, so one
    sample can be taken of another.
    """
    return drawn(sample_draw(row_id, seed, purpose), fraction)


def fold_number(row_id: Column, folds: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), row_id), F.lit(folds)).cast("int")


def correlation(x: Column, y: Column) -> Column:
    """Pearson r over the rows where both are known; NULL (no error) if one side is constant.

    From centred moments, which are merged without cancellation: a small spread on top of a large
    value (seconds since 1970, say) is still a spread, and a constant has none at all.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def unpivot_rows(names: Sequence[str], columns: dict[str, Sequence[Column]], key: str) -> Column:
    """``inline`` of one struct per name: turns one wide row into one row per name, no shuffle."""
    return F.inline(F.array(*[
        F.struct(F.lit(name).alias(key), *[cols[i].alias(out) for out, cols in columns.items()])
        for i, name in enumerate(names)]))
