"""Approximate quantiles of values with counts, by summaries that are merged.

A summary of some rows is a short list of (value, weight): the rows in order are cut where their
weight passes a multiple of a step, and each piece is stood for by its largest value. A value's rank in
the summary is less than a step below its rank in the rows. Steps are a share of the weight that is
summarised, so errors add up to that share of everything, in whatever pieces the rows come.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a task summarises together; bounds what it holds.
ROWS = 1 << 20


def summarise(values: np.ndarray, weights: np.ndarray, error: float) -> tuple[np.ndarray, np.ndarray]:
    """At most 1 / ``error`` + 1 (value, weight) with ranks that are right within ``error`` of all weight."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    below = np.cumsum(weights) - weights
    step = max(1.0, error * float(weights.sum()))
    piece = np.floor(below / step)
    last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True))
    return values[last], np.add.reduceat(weights, np.append(0, last[:-1] + 1))


def _summaries(rows: DataFrame, error: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, weights, size = [], [], 0

        def short() -> pa.RecordBatch:
            v, w = summarise(np.concatenate(values), np.concatenate(weights), error)
            return pa.RecordBatch.from_arrays([pa.array(v), pa.array(w)], names=["value", "weight"])

        for batch in batches:
            values.append(batch.column(0).to_numpy(zero_copy_only=False))
            weights.append(batch.column(1).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= ROWS:
                yield short()
                values, weights, size = [], [], 0
        if size:
            yield short()

    return rows.mapInArrow(work, "value double, weight long")


def approximate_quantiles(rows: DataFrame, probabilities: list[float], relative_error: float,
                          value: str = "s", weight: str | None = "n") -> DataFrame:
    """(probability, value): a value whose rank is within ``relative_error`` of all weight.

    Each row counts ``weight`` times (once if None); rows without a value or a positive weight are
    left out. What is summarised twice, in tasks and then over tasks, is at most
    shuffle partitions / ``relative_error`` rows at the end. No rows give NULL values.
    """
    if not 0 < relative_error < 1:
        raise ValueError("the relative error is between 0 and 1")
    counted = rows.select(F.col(value).cast("double").alias("value"),
                          (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("weight"))
    counted = counted.filter(F.col("value").isNotNull() & (F.col("weight") > 0))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = _summaries(_summaries(counted, relative_error / 2).repartition(parts), relative_error / 2)
    up_to = (Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = merged.groupBy("value").agg(F.sum("weight").alias("weight")).select(
        "value", F.sum("weight").over(up_to).alias("upto"),
        F.sum("weight").over(Window.partitionBy()).alias("total"))  # bounded as stated
    picks = ranked.agg(*[
        F.min(F.when(F.col("upto") >= F.lit(q) * F.col("total"), F.col("value"))).alias(f"q{i}")
        for i, q in enumerate(probabilities)])
    return picks.select(F.inline(F.array(*[
        F.struct(F.lit(float(q)).alias("probability"), F.col(f"q{i}").alias("value"))
        for i, q in enumerate(probabilities)])))


def rank_errors(rows: DataFrame, quantiles: DataFrame, value: str = "s", weight: str = "n") -> DataFrame:
    """``quantiles`` with ``rank_error``: how far the wanted rank is from the ranks of the value, as a
    share of all weight. Exact, by one aggregation; ``quantiles`` is a row per probability and is
    read first."""
    few = [(float(r["probability"]), r["value"]) for r in quantiles.collect()]
    total = F.sum(weight)
    errors = []
    for q, v in few:
        below = F.sum(F.when(F.col(value) < F.lit(v), F.col(weight)).otherwise(0))
        upto = F.sum(F.when(F.col(value) <= F.lit(v), F.col(weight)).otherwise(0))
        away = F.greatest(below - F.lit(q) * total, F.lit(q) * total - upto, F.lit(0.0))
        errors.append(F.struct(F.lit(q).alias("probability"), F.lit(v).cast("double").alias("value"),
                               F.try_divide(away, total).alias("rank_error")))
    return rows.agg(F.array(*errors).alias("e")).select(F.inline("e"))
