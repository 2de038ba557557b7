"""Experiments: what is fitted, how it is tuned, and how it is judged."""
from __future__ import annotations

import itertools
import math
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.param import Param
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.functions.columns import drawn, fold_number, sample_draw
from lagwise.ml.features import FEATURES, feature_pipeline
from lagwise.ml.transformers import PriorCorrector
from lagwise.operators.metrics import auc, binary_metrics
from lagwise.operators.sampling import (effective_rate, fraction_of, positive_weight,
                                        undersample_negatives, with_class_weights)


#: Training rows that a task should read at once; more rows than that in each make more tasks.
TRAIN_ROWS = 100_000


@dataclass(frozen=True)
class Experiment:
    name: str
    estimator: Estimator
    grid: Sequence[dict[Param, object]]
    scale: bool = False
    numeric: tuple[str, ...] | None = None

    def quick(self) -> Experiment:
        """The same experiment with the first grid point only."""
        return replace(self, grid=self.grid[:1])


_KINDS = {"logistic": LogisticRegression, "forest": RandomForestClassifier,
          "boosting": GBTClassifier}


def _experiment(name: str, config: Config) -> Experiment:
    kind, settings, axes, scale, with_past = fv.MODELS[name]
    estimator = _KINDS[kind](labelCol=config.columns.label, featuresCol=FEATURES, **settings)
    estimator.set(estimator.getParam("family"), "binomial") if kind == "logistic" \
        else estimator.setSeed(config.seed)
    points = [{estimator.getParam(axis): value for axis, value in zip(axes, values)}
              for values in itertools.product(*axes.values())]
    return Experiment(name, estimator, points, scale,
                      None if with_past else config.context_numeric)


def experiments(config: Config = Config()) -> dict[str, Experiment]:
    """The catalogue: a linear model without and with features of the past, and two kinds of trees."""
    return {name: _experiment(name, config) for name in fv.MODELS}


@contextmanager
def held(df: DataFrame, config: Config = Config()) -> Iterator[DataFrame]:
    """``df`` dealt to ``train_partitions`` by row id, sorted by it, and kept while a model iterates.

    If that would be more than ``TRAIN_ROWS`` in each, there are as many as the rows ask for. Bagging, sketches and sums go by partition and by place in it. Here both follow from the row ids
    alone, so a model does not depend on how its training rows were read, and adding a row moves
    no other, unless it asks for one more partition. Rows that share an id are ordered by their content.
    """
    row_id = config.columns.row_id
    content = F.xxhash64(*[F.col(c) for c in sorted(df.columns) if c != row_id])
    partitions = max(config.train_partitions, math.ceil(df.count() / TRAIN_ROWS))
    kept = (df.repartition(partitions, row_id)
            .sortWithinPartitions(row_id, content).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        yield kept
    finally:
        kept.unpersist()


def fit(train: DataFrame, experiment: Experiment, config: Config = Config(),
        params: dict[Param, object] | None = None) -> PipelineModel:
    pipeline = feature_pipeline(experiment.estimator, config, experiment.numeric,
                                experiment.scale)
    with held(train, config) as rows:
        return pipeline.fit(rows, params or {})


def scored(model: PipelineModel, df: DataFrame, kept_rate: float = 1.0,
           odds_factor: float | None = None) -> DataFrame:
    """Predictions with ``p_calibrated``, the probability at the real prevalence.

    Undersampled fits give the share of negatives kept, weighted ones the factor for the odds.
    """
    return PriorCorrector(keptRate=kept_rate, oddsFactor=odds_factor).transform(model.transform(df))


def undersampled_fit(train: DataFrame, experiment: Experiment, config: Config = Config(),
                     rate: float | None = None) -> tuple[PipelineModel, float]:
    """Fit on the undersampled training rows; also return the rate that recalibrates it."""
    return (fit(undersample_negatives(train, config, rate), experiment, config),
            effective_rate(train, config, rate))


def weighted_fit(train: DataFrame, experiment: Experiment, config: Config = Config()
                 ) -> tuple[PipelineModel, float]:
    """The same model on every training row with class weights.

    A weight w on positives multiplies the odds by w, so 1/w is the factor that recalibrates them;
    it is above one where positives are the majority.
    """
    weight = positive_weight(train, config).first()["weight"]
    estimator = experiment.estimator.copy()
    estimator.set(estimator.getParam("weightCol"), "weight")
    model = fit(with_class_weights(train, config), replace(experiment, estimator=estimator),
                config)
    return model, 1.0 / weight


@dataclass(frozen=True)
class Tuned:
    model: PipelineModel
    scores: list[float]
    best: int
    params: dict[str, object]
    fits: int
    search_seconds: float
    refit_seconds: float


def tune(train: DataFrame, experiment: Experiment, config: Config = Config(),
         metric: str = "areaUnderPR", search_fraction: float | None = None) -> Tuned:
    """k-fold search on a sample, then refit of the winner on all of ``train``.

    The grid only changes the estimator, so in each fold the feature stages are fitted and the
    vectors built once, for all grid points. Folds follow the row id, so they are the same on
    any layout of the data; they run side by side, as their jobs are short and wait a lot.
    """
    fraction = config.search_fraction if search_fraction is None else search_fraction
    c, grid = config.columns, list(experiment.grid)
    evaluator = BinaryClassificationEvaluator(labelCol=c.label, metricName=metric,
                                              rawPredictionCol="rawPrediction", numBins=0)
    fold = fold_number(F.col(c.row_id), config.folds, config.seed)
    start = time.perf_counter()
    with held(fraction_of(train, fraction, config, "search")
              .withColumn("_fold", fold), config) as sample:

        def judged(k: int) -> list[float]:
            learn, judge = sample.filter(F.col("_fold") != k), sample.filter(F.col("_fold") == k)
            prepare = feature_pipeline(None, config, experiment.numeric, experiment.scale) \
                .fit(learn)
            vectors, held_out = [
                prepare.transform(part).select(FEATURES, c.label)
                .persist(StorageLevel.MEMORY_AND_DISK) for part in (learn, judge)]
            scores = [0.0] * len(grid)
            for i, model in experiment.estimator.fitMultiple(vectors, grid):
                scores[i] = evaluator.evaluate(model.transform(held_out))
            vectors.unpersist()
            held_out.unpersist()
            return scores

        in_session = inheritable_thread_target(train.sparkSession)
        with ThreadPool(min(config.folds, config.parallel_folds)) as pool:
            folds = pool.map(in_session(judged), range(config.folds))
    totals = [sum(scores) for scores in zip(*folds)]
    searched = time.perf_counter()
    scores = [t / config.folds for t in totals]
    best = max(range(len(grid)), key=scores.__getitem__)
    model = fit(train, experiment, config, grid[best])
    return Tuned(model, scores, best, {p.name: v for p, v in grid[best].items()},
                 config.folds * len(grid) + 1, searched - start, time.perf_counter() - searched)


def grid_table(tuned: Tuned, experiment: Experiment, like: DataFrame) -> DataFrame:
    """One row per grid point."""
    rows = [(experiment.name, i, ", ".join(f"{p.name}={v}" for p, v in point.items()), score,
             i == tuned.best) for i, (point, score) in enumerate(zip(experiment.grid,
                                                                     tuned.scores))]
    return like.sparkSession.createDataFrame(
        rows, "experiment string, point int, params string, cv_auc_pr double, best boolean")


def fit_record(tuned: Tuned, like: DataFrame) -> DataFrame:
    """One row: the search's score and winner, the number of fits, and the seconds."""
    winner = ", ".join(f"{k}={v}" for k, v in tuned.params.items())
    return like.sparkSession.createDataFrame(
        [(tuned.scores[tuned.best], winner, tuned.fits, tuned.search_seconds, tuned.refit_seconds)],
        "cv_auc_pr double, params string, fits int, search_seconds double, refit_seconds double")


def optimism_gap(tuned: Tuned, val: DataFrame, kept_rate: float, config: Config = Config(),
                 val_scores: DataFrame | None = None) -> DataFrame:
    """Cross-validated score minus the score on validation rows undersampled at the same rate.

    AUC-PR moves with prevalence, so only like is compared with like; AUC-ROC does not, and its
    difference between the sampled and the full validation set is the control. ``val_scores`` is the
    score table of ``val``, if there is one already.
    """
    sampled = undersample_negatives(val, config, kept_rate)
    same = auc(scored(tuned.model, sampled, kept_rate), config=config)
    full = auc(scored(tuned.model, val, kept_rate) if val_scores is None else val_scores,
               config=config)
    full_roc = full.select("auc_roc").scalar()
    cv = F.lit(tuned.scores[tuned.best])
    return same.select(cv.alias("cv_auc_pr"), F.col("auc_pr").alias("val_auc_pr_sampled"),
                       (cv - F.col("auc_pr")).alias("optimism_gap"),
                       (F.col("auc_roc") - full_roc).alias("auc_roc_gap"))


def learning_curve(train: DataFrame, evaluate: DataFrame, experiment: Experiment,
                   kept_rate: float, fractions: Sequence[float] = (0.1, 0.25, 0.5, 1.0),
                   config: Config = Config()) -> DataFrame:
    """What more training rows buy: the same fit on nested samples, judged on the same rows.

    The training rows are kept once, with the draw that decides which samples a row is in; one
    count gives the sizes of all samples, and each sample is a filter.
    """
    pipeline = feature_pipeline(experiment.estimator, config, experiment.numeric, experiment.scale)
    draw = sample_draw(F.col(config.columns.row_id), config.seed, "curve")

    def point(rows: DataFrame, fraction: float, size: int) -> tuple:
        began = time.perf_counter()
        model = pipeline.fit(rows.filter(drawn("_draw", fraction)))
        took = time.perf_counter() - began
        quality = binary_metrics(scored(model, evaluate, kept_rate), config=config).first()
        return (float(fraction), size, took, quality["auc_pr"], quality["auc_roc"], size / took)

    with held(train.withColumn("_draw", draw), config) as rows:
        sizes = rows.agg(*[F.count_if(drawn("_draw", f)) for f in fractions]).first()
        points = [point(rows, f, n) for f, n in zip(fractions, sizes)]
    return train.sparkSession.createDataFrame(
        points, "fraction double, rows bigint, seconds double, auc_pr double, auc_roc double, "
                "rows_per_second double")
