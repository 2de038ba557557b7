"""Time columns of the impression table, derived once, at ingestion."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import count_where, day_part, flag, shift_hours, utc_timestamp


def with_time_features(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Add UTC and local time, local date and hour, part of day, weekday, weekend flag.

    Everything is zone-free, so the session time zone cannot move a row to another day.
    """
    c = config.columns
    ts_utc = utc_timestamp(F.col(c.time))
    local = F.col("ts_local")
    return (
        df.withColumn("ts_utc_s", ts_utc)
        .withColumn("ts_local", shift_hours(ts_utc, config.utc_offset_hours))
        .withColumns({
            c.day: F.to_date(local),
            "hour": F.hour(local),
            "day_part": day_part(F.hour(local)),
            "dow": F.dayofweek(local),
            "weekend": flag(F.dayofweek(local).isin(1, 7)),
        })
    )


def with_row_id(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Add a row id made from the content, unless the table brings one.

    Needs no shuffle and is the same in every run. Outcomes have no part in it, or the order of
    rows that tie on everything else would follow their own label; such rows share an id, and the
    windows count none of them as earlier than another. A NULL is a value of its own.
    """
    c = config.columns
    if c.row_id in df.columns:
        return df
    known = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("-"))
             for n in df.columns if n not in (c.label, *config.outcomes)]
    return df.withColumn(c.row_id, F.xxhash64(*known))


def undated_rows(*tables: tuple[str, DataFrame], config: Config = Config()) -> DataFrame:
    """Rows per table, and how many have no usable time; these enter no history and no split."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      count_where(F.col(config.columns.time).isNull()).alias("undated")).select(
            F.lit(name).alias("table_name"), "rows", "undated")

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables])


def ingest_impressions(typed: DataFrame, config: Config = Config()) -> DataFrame:
    """A contract-read impression table: user column renamed, row id and time columns added."""
    renamed = typed.withColumnRenamed("user", config.columns.user)
    return with_time_features(with_row_id(renamed, config), config)
