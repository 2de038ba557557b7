"""Orders over a whole table, or over one key with very many rows, without a task that holds them.

Rows are dealt to ranges of the order, evenly by number, and written. What a row needs to know of all
earlier ranges is a running total over a table of one row per range.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.sources.layers import staged

PART = "_part"
#: Rows that are worth a task of their own. Shorter ranges are cut inside of tasks.
TASK_ROWS = 100_000


def range_count(df: DataFrame, rows: int = 0, per_range: int = 1) -> int:
    """As many ranges as the session has shuffle partitions, more if a range would exceed ``per_range``
    and ``TASK_ROWS``: each is a task, so short ranges must not decide how many there are."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               math.ceil(rows / max(per_range, TASK_ROWS)))


def dealt(df: DataFrame, order: list[Column], ranges: int, name: str) -> DataFrame:
    """``df`` with ``_part``, the number of its range; written, so that everyone sees the same ranges.

    Only rows that tie on the whole order are kept together.
    """
    return staged(df.repartitionByRange(ranges, *order).withColumn(PART, F.spark_partition_id()), name)


def sliced(dealt_rows: DataFrame, order: list[Column], per_range: int, name: str) -> DataFrame:
    """Ranges of :func:`dealt` cut into shorter ones of about ``per_range`` rows, by places inside of each.

    ``_part`` becomes a number that ascends over all of them. Rows that tie on the whole order share a
    place, so they stay together. Ranges that are meant to be as long as a task's stay as they are.
    """
    if per_range >= TASK_ROWS:
        return dealt_rows
    place = F.rank().over(Window.partitionBy(PART).orderBy(*order)) - 1
    short = F.shiftleft(F.col(PART).cast("bigint"), 32) + F.floor(place / per_range)
    return staged(dealt_rows.withColumn("_short", short).drop(PART).withColumnRenamed("_short", PART), name)


def numbered(df: DataFrame, order: list[Column], column: str, name: str = "ranges") -> DataFrame:
    """``df`` with its place in the order, from 0; rows that tie get places in any order."""
    rows = dealt(df, order, range_count(df), name)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("_n")).select(
        PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(PART).orderBy(*order)) - 1
    placed = rows.withColumn("_inside", inside).join(F.broadcast(starts), PART)
    return placed.withColumn(column, F.col("_start") + F.col("_inside")).drop(PART, "_start", "_inside")
