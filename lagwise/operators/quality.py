"""Join checks, missingness profile, imputation decisions and their application."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.errors import DataQualityError
from lagwise.functions.columns import count_where, ratio, two_proportion_z, unpivot_rows
from lagwise.operators.enrich import sentinel
from lagwise.sources.layers import staged


# --- join cardinality ---------------------------------------------------------------------------

def _key_counts(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def _row_verdict(rows: Column, expected: Column) -> Column:
    return (F.when(rows == expected, fv.OK)
            .when(rows > expected, fv.DUPLICATES)
            .otherwise(fv.LOSES_ROWS))


def join_cardinality(impressions: DataFrame, ads: DataFrame, profiles: DataFrame,
                     config: Config = Config()) -> DataFrame:
    """What the two joins would do to the row count, and whether the dimension keys are unique.

    The first join is sized from impressions and ads per ad key, so a hot ad is one row per task.
    The second changes that size only at users with several profiles: only their impressions, none
    if all is well, are looked at for it.
    """
    c = config.columns
    ad_keys = _key_counts(ads, c.ad, "n_ad")
    user_keys = _key_counts(profiles, c.user, "n_user")
    zero = F.lit(0)
    inner = _key_counts(impressions, c.ad, "n").join(ad_keys, c.ad, "left").agg(
        F.coalesce(F.sum("n"), zero).alias("expected"),
        F.coalesce(F.sum(F.col("n") * F.coalesce("n_ad", zero)), zero).alias("inner"))
    several = staged(user_keys.filter("n_user > 1"), "repeated-profiles")
    more = impressions.select(c.ad, c.user).join(several, c.user).groupBy(c.ad).agg(
        F.sum(F.col("n_user") - 1).alias("more")).join(ad_keys, c.ad).agg(
        F.coalesce(F.sum(F.col("more") * F.col("n_ad")), zero)).scalar()
    sizes = inner.withColumn("both", F.col("inner") + more)
    joins = sizes.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(rows).alias("rows"),
                 (F.col(rows) - F.col("expected")).alias("delta"),
                 _row_verdict(F.col(rows), F.col("expected")).alias("verdict"))
        for name, rows in (("inner_ads", "inner"), ("inner_ads_left_profiles", "both"))])))

    def key_check(name: str, keys: DataFrame, key: str, n: str) -> DataFrame:
        found = keys.agg(F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
                         F.count(key).alias("distinct"))
        delta = F.col("rows") - F.col("distinct")
        return found.select(
            F.lit(name).alias("check"), "rows", delta.alias("delta"),
            F.when(delta == 0, fv.OK).otherwise(fv.KEY_NOT_UNIQUE).alias("verdict"))

    return reduce(DataFrame.unionByName, [
        joins,
        key_check("ads_key_unique", ad_keys, c.ad, "n_ad"),
        key_check("profiles_key_unique", user_keys, c.user, "n_user")])


def require_all_ok(checks: DataFrame, what: str) -> None:
    """Stop the run if any verdict is not OK. ``checks`` has a handful of rows.

    A feature without spread cannot follow the label: that verdict is reported, but stops nothing.
    """
    bad = checks.filter(~F.col("verdict").isin(fv.OK, fv.NO_SPREAD)).toJSON().take(20)
    if bad:
        raise DataQualityError(f"{what}: {bad}")


# --- missingness --------------------------------------------------------------------------------

def user_totals(impressions: DataFrame, config: Config = Config()) -> DataFrame:
    c = config.columns
    return impressions.groupBy(c.user).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c.label).alias("clicks"))


def missingness_profile(impressions: DataFrame, profiles: DataFrame,
                        config: Config = Config()) -> DataFrame:
    """Per profile column, over the join: how much is missing and whether missing rows click
    differently (two-proportion z).

    Impressions are first summed per user, so the join sees one row per user, however many
    impressions one user has; all columns are measured in the same pass.
    """
    c, cols = config.columns, list(config.profile_columns)
    joined = user_totals(impressions, config).join(profiles, c.user, "left")
    totals = joined.agg(
        F.sum("n").alias("n"), F.sum("clicks").alias("clicks"),
        *[F.coalesce(F.sum(F.when(F.col(p).isNull(), F.col("n"))), F.lit(0)).alias(f"n_{p}")
          for p in cols],
        *[F.coalesce(F.sum(F.when(F.col(p).isNull(), F.col("clicks"))), F.lit(0)).alias(f"k_{p}")
          for p in cols])
    long = totals.select("n", "clicks", unpivot_rows(cols, {
        "n_null": [F.col(f"n_{p}") for p in cols],
        "clicks_null": [F.col(f"k_{p}") for p in cols]}, key="column_name"))
    n_known, clicks_known = F.col("n") - F.col("n_null"), F.col("clicks") - F.col("clicks_null")
    ctr_null = 100 * ratio(F.col("clicks_null"), F.col("n_null"))
    ctr_known = 100 * ratio(clicks_known, n_known)
    z = two_proportion_z(F.col("clicks_null"), F.col("n_null"), clicks_known, n_known)
    return long.select(
        "column_name",
        (100 * ratio(F.col("n_null"), F.col("n"))).alias("pct_null"),
        "n_null",
        ctr_null.alias("ctr_null"),
        ctr_known.alias("ctr_not_null"),
        F.when(ctr_null > 0, F.try_divide(ctr_null, ctr_known)).alias("ratio"),
        z.alias("z"))


def shown(table: DataFrame) -> DataFrame:
    """For display: doubles to six decimals. Decisions are never taken on this."""
    return table.select(*[F.round(c, 6).alias(c) if kind == "double" else c
                          for c, kind in table.dtypes])


def imputation_decision(profile: DataFrame, config: Config = Config()) -> DataFrame:
    """Add ``decision`` and ``reason``: thresholds decide, unless absence itself is informative.

    Works on what :func:`missingness_profile` measured, unrounded; "nothing missing" is a count.
    """
    share = F.col("pct_null") / 100
    complete = F.col("n_null") == 0
    informative = F.coalesce(F.abs("z") > config.z_critical, F.lit(False))
    drop_pct, impute_pct = 100 * config.drop_threshold, 100 * config.impute_threshold
    decision = (F.when(complete, fv.NO_ACTION)
                .when(informative, fv.KEEP_UNKNOWN)
                .when(share <= config.drop_threshold, fv.DROP_ROWS)
                .when(share <= config.impute_threshold, fv.IMPUTE_MODE)
                .otherwise(fv.KEEP_UNKNOWN))
    size = (F.when(share <= config.drop_threshold, f"at most {drop_pct:g}% missing")
            .when(share <= config.impute_threshold, f"at most {impute_pct:g}% missing")
            .otherwise(f"more than {impute_pct:g}% missing"))
    why = (F.when(complete, "nothing missing in the join")
           .when(informative, F.concat(size, F.lit("; absence is informative")))
           .when(share > config.impute_threshold,
                 F.concat(size, F.lit("; too many to impute")))
           .otherwise(size))
    return profile.withColumns({"decision": decision, "reason": why})


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the most frequent known value of each column (smallest value on a tie).

    Each column is counted by value, so what is compared is the small table of distinct values.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("int").alias("value"))
        for c in columns])))
    counts = (long.filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column_name").agg(
        F.max(F.struct("n", (-F.col("value")).alias("value"))).alias("top"))
    return best.agg(*[
        (-F.max(F.when(F.col("column_name") == c, F.col("top.value")))).alias(c)
        for c in columns])


def apply_imputation(df: DataFrame, decisions: dict[str, str]) -> DataFrame:
    """Carry the decisions out: keep as is, drop rows, fill the mode, or fill the sentinel.

    ``decisions`` maps column to decision (one entry per profile column, see
    :func:`decisions_by_column`). Modes are taken from the rows that are kept.
    """
    dropped = [c for c, d in decisions.items() if d == fv.DROP_ROWS]
    moded = [c for c, d in decisions.items() if d == fv.IMPUTE_MODE]
    kept = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dropped])) \
        if dropped else df
    filled = {c: F.col(c).cast("int") for c in decisions}
    filled |= {c: sentinel(c) for c, d in decisions.items() if d == fv.KEEP_UNKNOWN}
    if moded:
        modes = column_modes(kept, moded).select(F.struct(*moded)).scalar()
        filled |= {c: F.coalesce(F.col(c).cast("int"), modes[c]) for c in moded}
    return kept.withColumns(filled)


def decisions_by_column(decisions: DataFrame) -> dict[str, str]:
    """The decision table as a mapping; it has one row per profile column."""
    return {r["column_name"]: r["decision"]
            for r in decisions.select("column_name", "decision").collect()}


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass, as rows."""
    wide = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    return wide.select(unpivot_rows(columns, {"nulls": [F.col(c) for c in columns]}, "feature"))
