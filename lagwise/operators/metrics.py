"""Evaluating a click probability, by distributed aggregation only.

Everything here depends on a prediction only through its score and its label, so predictions are
read into one row per distinct score; all metrics are aggregates of that table. Given predictions, a
metric makes the table for itself; :func:`score_table` makes one for several.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import log_loss, ratio, unpivot_rows
from lagwise.sources.layers import staged


def constant_prior(train: DataFrame, evaluate: DataFrame, config: Config = Config(),
                   score: str = "p_calibrated") -> DataFrame:
    """The baseline: every row gets the training click rate."""
    p0 = train.agg(F.avg(F.col(config.columns.label).cast("double"))).scalar()
    return evaluate.withColumn(score, p0)


def score_counts(pred: DataFrame, score: str = "p_calibrated",
                 config: Config = Config()) -> DataFrame:
    """Rows and positives per distinct score: ``s, n, pos``. A missing score is an error."""
    s = F.coalesce(F.col(score).cast("double"), F.raise_error(F.lit(f"NULL in {score}")))
    return pred.select(s.alias("s"), F.col(config.columns.label).cast("bigint").alias("y")) \
        .groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))


_TABLE = ["s", "n", "pos", "slice"]


def score_table(pred: DataFrame, score: str = "p_calibrated", config: Config = Config()) -> DataFrame:
    """:func:`score_counts`, written once, in slices from the highest scores down.

    Slices are ranges of the scores that occur, so they are even however closely the scores lie.
    Every metric here takes such a table in place of predictions; a run that wants several scores
    its rows once.
    """
    if pred.columns == _TABLE:
        return pred
    parts = int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = score_counts(pred, score, config).repartitionByRange(parts, F.col("s").desc())
    return staged(sliced.withColumn("slice", F.spark_partition_id()), "scores")


def ranked(table: DataFrame) -> DataFrame:
    """A score table with the counts from the highest score down to each one, and the total.

    A running total over all scores would be one task. Scores are summed within slices, then
    shifted by the totals of the higher slices, a table of one row per slice.
    """
    higher = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (table.groupBy("slice").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
               .select("slice", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("_n0"),
                       F.coalesce(F.sum("pos").over(higher), F.lit(0)).alias("_pos0"),
                       F.sum("n").over(Window.partitionBy()).alias("n_all")))
    within = (Window.partitionBy("slice").orderBy(F.col("s").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = table.withColumns({"_n1": F.sum("n").over(within), "_pos1": F.sum("pos").over(within)})
    joined = summed.join(F.broadcast(offsets), "slice")  # one row per partition of the table
    return joined.select("s", "n", "pos", "n_all", (F.col("_n0") + F.col("_n1")).alias("n_cum"),
                         (F.col("_pos0") + F.col("_pos1")).alias("pos_cum"))


def _area_sums() -> dict[str, Column]:
    """Sums over ranked scores that give both areas (trapezoids; tied scores are one point).

    The precision-recall curve starts at recall 0 with the precision of the first point.
    """
    n, pos = F.col("n").cast("double"), F.col("pos").cast("double")
    n_cum, pos_cum = F.col("n_cum").cast("double"), F.col("pos_cum").cast("double")
    precision = pos_cum / n_cum
    before = F.when(n_cum > n, F.try_divide(pos_cum - pos, n_cum - n)).otherwise(precision)
    return {"_p": F.sum("pos").cast("double"), "_q": F.sum(n - pos),
            "_roc": F.sum((n - pos) * (pos_cum - pos / 2)),
            "_pr": F.sum(pos * (precision + before) / 2)}


def _areas() -> dict[str, Column]:
    return {"auc_roc": F.try_divide(F.col("_roc"), F.col("_p") * F.col("_q")),
            "auc_pr": F.try_divide(F.col("_pr"), F.col("_p"))}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def auc(pred: DataFrame, score: str = "p_calibrated", config: Config = Config()) -> DataFrame:
    """Exact areas under the ROC and precision-recall curves, one row."""
    sums = ranked(score_table(pred, score, config)).agg(*_aliased(_area_sums()))
    return sums.select(*_aliased(_areas()))


def binary_metrics(pred: DataFrame, score: str = "p_calibrated",
                   config: Config = Config()) -> DataFrame:
    """One row: size, observed and predicted rate, log-loss, Brier, AUCs, lift, calibration."""
    s, pos = F.col("s"), F.col("pos")
    neg, one, zero = F.col("n") - pos, F.lit(1), F.lit(0)
    sums = ranked(score_table(pred, score, config)).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("_pos"), F.sum(s * F.col("n")).alias("_s"),
        F.sum(pos * log_loss(one, s) + neg * log_loss(zero, s)).alias("_loss"),
        F.sum(pos * (1 - s) * (1 - s) + neg * s * s).alias("_square"), *_aliased(_area_sums()))
    means = sums.withColumns({
        "observed": ratio(F.col("_pos"), F.col("n")), "predicted": ratio(F.col("_s"), F.col("n")),
        "logloss": ratio(F.col("_loss"), F.col("n")), "brier": ratio(F.col("_square"), F.col("n")),
        **_areas()})
    full = means.withColumns({
        "auc_pr_lift": ratio(F.col("auc_pr"), F.col("observed")),
        "calibration_bias": ratio(F.col("predicted"), F.col("observed"))})
    return full.select("n", *[F.round(m, 6).alias(m) for m in (
        "observed", "predicted", "logloss", "brier", "auc_roc", "auc_pr", "auc_pr_lift",
        "calibration_bias")])


def sampling_effect(full: DataFrame, sampled: DataFrame, score: str = "p_calibrated",
                    config: Config = Config()) -> DataFrame:
    """The same scores judged on all rows and on an undersampled set, metric by metric."""
    names = ["observed", "auc_roc", "auc_pr", "logloss"]

    def long(pred: DataFrame, out: str) -> DataFrame:
        return binary_metrics(pred, score, config).select(
            unpivot_rows(names, {out: [F.col(m) for m in names]}, "metric"))

    both = long(full, "full").join(long(sampled, "sampled"), "metric")
    return both.withColumn("relative_difference", F.round(
        F.try_divide(F.col("sampled") - F.col("full"), F.col("full")), 6))


def exact_quantiles(table: DataFrame, probabilities: list[float]) -> DataFrame:
    """Of a score table: one row with one column ``q0, q1, ...`` per probability, linearly interpolated.

    Picks the two neighbouring order statistics out of the running counts, so nothing is sorted
    in one place and nothing is approximated.
    """
    rows = ranked(table)
    below = F.col("n_all") - F.col("n_cum")

    def at(position: Column) -> Column:
        return F.max(F.when((below <= position) & (position < below + F.col("n")), F.col("s")))

    picks, values = [], []
    for i, q in enumerate(probabilities):
        place = F.lit(q) * (F.col("n_all") - 1)
        picks += [at(F.floor(place)).alias(f"lo{i}"), at(F.ceil(place)).alias(f"hi{i}"),
                  F.max(place - F.floor(place)).alias(f"f{i}")]
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        values.append((low + (high - low) * F.col(f"f{i}")).alias(f"q{i}"))
    return rows.agg(*picks).select(*values)


def score_deciles(pred: DataFrame, score: str = "p_calibrated", buckets: int = 10,
                  relative_error: float | None = None, config: Config = Config()) -> DataFrame:
    """Click rate and lift by score bucket; D1 is the highest bucket that has rows.

    The bucket of a row is the number of cut points strictly below its score. Cut points are
    exact, or come from ``approxQuantile`` if a relative error is given and ``pred`` has one row per
    impression; a score table has rows with counts, and its cut points are always exact.
    """
    counts = score_table(pred, score, config)
    probabilities = [i / buckets for i in range(1, buckets)]
    if relative_error is None or pred.columns == _TABLE:
        names = [f"q{i}" for i in range(len(probabilities))]
        cut = exact_quantiles(counts, probabilities).select(F.struct(*names)).scalar()
        rows = counts.withColumn("_cut", cut)  # one column, so the subquery is planned once
        cuts = [F.col(f"_cut.{name}") for name in names]
    else:
        rows = counts
        cuts = [F.lit(v) for v in pred.approxQuantile(score, probabilities, relative_error)]
    bucket = sum(((F.col("s") > v).cast("int") for v in cuts), F.lit(0))
    per_bucket = rows.withColumn("bucket", bucket).groupBy("bucket").agg(
        F.sum("n").alias("impressions"), F.sum("pos").alias("clicks"),
        F.sum(F.col("s") * F.col("n")).alias("_s"))
    everything = Window.partitionBy()  # over at most ``buckets`` rows
    rate = ratio(F.col("clicks"), F.col("impressions"))
    overall = ratio(F.sum("clicks").over(everything), F.sum("impressions").over(everything))
    from_top = F.row_number().over(Window.orderBy(F.col("bucket").desc()))
    return per_bucket.select(
        F.concat(F.lit("D"), from_top.cast("string")).alias("decile"),
        "impressions", "clicks", F.round(100 * rate, 6).alias("ctr_pct"),
        F.round(100 * ratio(F.col("_s"), F.col("impressions")), 6).alias("mean_score_pct"),
        F.round(F.try_divide(rate, overall), 6).alias("lift")).orderBy(F.col("bucket").desc())


def pr_curve(pred: DataFrame, score: str = "p_calibrated", points: int = 60,
             config: Config = Config()) -> DataFrame:
    """Precision and recall at evenly spaced thresholds, from one histogram of the scores."""
    bin_of = F.least(F.floor(F.col("s") * points), F.lit(points - 1)).cast("int")
    bins = score_table(pred, score, config).groupBy(bin_of.alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    down = (Window.orderBy(F.col("bin").desc())  # at most ``points`` rows
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    all_pos = F.sum("pos").over(Window.partitionBy())
    n_cum, pos_cum = F.sum("n").over(down), F.sum("pos").over(down)
    return bins.select(
        F.round(F.col("bin") / F.lit(float(points)), 6).alias("threshold"),
        n_cum.alias("n_cum"), F.round(ratio(pos_cum, n_cum), 6).alias("precision"),
        F.round(F.coalesce(ratio(pos_cum, all_pos), F.lit(0.0)), 6).alias("recall")).orderBy(
        F.col("threshold").desc())
