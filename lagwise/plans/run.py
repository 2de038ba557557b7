"""From three CSV files to judged models: layers, gates, experiments, recommendation.

``python -m lagwise.plans.run --csv FOLDER --out FOLDER [--quick] [--only lr_full,...]``
"""
from __future__ import annotations

import argparse
import time
from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.ml import features as feat
from lagwise.ml import models
from lagwise.operators import (enrich, leakage, metrics, quality, ranking, recommend, sampling,
                               split)
from lagwise.operators.gold import gold_columns, gold_features
from lagwise.operators.ingest import ingest_impressions
from lagwise.sources import contract, layers


@dataclass(frozen=True)
class Bronze:
    impressions: DataFrame
    ads: DataFrame
    profiles: DataFrame


def csv_reads(spark: SparkSession, csv: str) -> dict[str, contract.ContractRead]:
    return {c.name: contract.read_csv(spark, c, f"{csv}/{c.name}.csv")
            for c in (contract.IMPRESSIONS, contract.ADS, contract.PROFILES)}


def build_bronze(spark: SparkSession, csv: str, out: str, config: Config = Config(),
                 rebuild: bool = False, grow: bool = False) -> Bronze:
    """Typed Parquet copies of the CSV files, impressions by local date; reused if valid.

    With ``grow``, dates that the impressions do not hold yet are added, and ads and profiles are
    written again."""
    c, reads = config.columns, csv_reads(spark, csv)
    impressions = layers.build_layer(
        spark, f"{out}/impressions",
        [c.row_id, c.user, c.time, c.ad, c.slot, c.label, "ts_local", c.day, "hour", "day_part"],
        lambda: ingest_impressions(reads["raw_sample"].typed, config), c.day, rebuild,
        repr(config), grow)
    ads, profiles = [
        layers.build_layer(spark, f"{out}/{t.name}", t.required,
                           lambda t=t: reads[t.name].typed, rebuild=rebuild or grow)
        for t in (contract.ADS, contract.PROFILES)]
    layers.register_views({"impressions": impressions, "ad_feature": ads,
                           "user_profile": profiles})
    return Bronze(impressions, ads, profiles)


def build_silver(spark: SparkSession, bronze: Bronze, out: str, config: Config = Config(),
                 rebuild: bool = False, grow: bool = False) -> DataFrame:
    """The enriched layer, after the join gate and with the measured imputation decisions.

    Only decisions to drop rows or impute a mode differ from the sentinel default.
    """
    quality.require_all_ok(quality.join_cardinality(
        bronze.impressions, bronze.ads, bronze.profiles, config), "join cardinality")
    decided = quality.decisions_by_column(quality.imputation_decision(
        quality.missingness_profile(bronze.impressions, bronze.profiles, config), config))
    decided = {c: fv.KEEP_UNKNOWN if d == fv.NO_ACTION else d for c, d in decided.items()}
    silver = layers.build_layer(
        spark, f"{out}/silver", [*config.profile_columns, "no_profile", "brand_known"],
        lambda: quality.apply_imputation(enrich.enriched(
            bronze.impressions, bronze.ads, bronze.profiles, config), decided),
        config.columns.day, rebuild, repr(config), grow)
    layers.register_views({"silver": silver})
    return silver


def build_gold(spark: SparkSession, silver: DataFrame, out: str, config: Config = Config(),
               rebuild: bool = False, origin: int | None = None, grow: bool = False) -> DataFrame:
    """The feature layer, after the leakage gate.

    No feature looks ahead, so with ``grow`` the rows of the dates it holds stay as they are."""
    gold = layers.build_layer(
        spark, f"{out}/gold", gold_columns(config),
        lambda: gold_features(silver, config, origin), config.columns.day, rebuild, repr(config),
        grow)
    layers.register_views({"gold": gold})
    leakage.require_leak_free(gold, config)
    return gold


def published(df: DataFrame) -> DataFrame:
    """The same table under the published column names."""
    return df.withColumnsRenamed(fv.PUBLISHED_NAMES)


def _named(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("experiment"), "*")


def run_experiments(gold: DataFrame, config: Config = Config(),
                    only: Iterable[str] | None = None, quick: bool = False
                    ) -> dict[str, DataFrame]:
    """Tune, refit and judge the catalogue against the constant baseline.

    Models learn from undersampled rows; they are always judged on all rows of a day.
    """
    train, val, test = split.temporal_split(gold, config)
    rate = sampling.effective_rate(train, config)
    learn = sampling.undersample_negatives(train, config)
    catalogue = models.experiments(config)
    tables: dict[str, list[DataFrame]] = {k: [] for k in (
        "metrics", "fits", "grid", "deciles", "pr_curve", "weights", "optimism",
        "sampling_effect")}
    for name, days in (("val", val), ("test", test)):
        tables["metrics"].append(_named("baseline_prior", _judged(name, metrics.score_table(
            metrics.constant_prior(train, days, config), config=config), config)))
    for experiment in [catalogue[n] for n in (only or catalogue)]:
        e = experiment.quick() if quick else experiment
        tuned = models.tune(learn, e, replace(config, folds=2) if quick else config,
                            search_fraction=1.0 if quick else None)
        # The rows of each day set are scored once; all that is said about them comes from these.
        on_val, on_test, sampled = [
            metrics.score_table(models.scored(tuned.model, rows, rate), config=config)
            for rows in (val, test, sampling.undersample_negatives(test, config, rate))]
        for name, df in (
                ("metrics", _judged("val", on_val, config)),
                ("metrics", _judged("test", on_test, config)),
                ("fits", models.fit_record(tuned, gold)),
                ("deciles", metrics.score_deciles(on_test, config=config)),
                ("pr_curve", metrics.pr_curve(on_test, config=config)),
                ("weights", feat.feature_weights(tuned.model, test)),
                ("optimism", models.optimism_gap(tuned, val, rate, config, on_val)),
                ("sampling_effect", metrics.sampling_effect(on_test, sampled, config=config))):
            tables[name].append(_named(e.name, df))
        tables["grid"].append(models.grid_table(tuned, e, gold))
    return {name: reduce(DataFrame.unionByName, parts) for name, parts in tables.items()}


def _judged(days: str, scores: DataFrame, config: Config) -> DataFrame:
    """All single-number metrics of one set of days, the lift of the top bucket among them."""
    top = metrics.score_deciles(scores, config=config).filter("decile = 'D1'").select("lift").scalar()
    return metrics.binary_metrics(scores, config=config).select(
        F.lit(days).alias("days"), "*", top.alias("d1_lift"))


def best_experiment(judged: DataFrame) -> str:
    """The name of the model with the largest area under precision-recall on the test days."""
    models_only = judged.filter("days = 'test' AND experiment <> 'baseline_prior'")
    return models_only.orderBy(F.col("auc_pr").desc(), "experiment").first()["experiment"]


def run_weighted(gold: DataFrame, config: Config = Config()) -> DataFrame:
    """The linear model on every training row with class weights, judged on the test days.

    Stated beside it: the undersampled fit of the same model, the seconds of both, and what the
    weights cost and bring.
    """
    train, _, test = split.temporal_split(gold, config)
    experiment = models.experiments(config)["lr_full"]
    rows, seconds, scores = [], {}, {}
    for name, fit in (("lr_weighted", models.weighted_fit), ("lr_undersampled", models.undersampled_fit)):
        start = time.perf_counter()
        model, number = fit(train, experiment, config)
        seconds[name] = time.perf_counter() - start
        rated = {"odds_factor": number} if name == "lr_weighted" else {"kept_rate": number}
        table = metrics.score_table(models.scored(model, test, **rated), config=config)
        rows.append(_named(name, _judged("test", table, config)).withColumn(
            "fit_seconds", F.lit(seconds[name])))
    both = layers.staged(reduce(DataFrame.unionByName, rows), "weighted")

    def base(name: str) -> Column:
        under = F.when(F.col("experiment") == "lr_undersampled", F.col(name))
        return F.max(under).over(Window.partitionBy())  # two rows

    return both.select(
        "*", (F.col("auc_pr") - base("auc_pr")).alias("delta_auc_pr"),
        F.try_divide("fit_seconds", base("fit_seconds")).alias("time_ratio"))


def run_recommendation(gold: DataFrame, config: Config = Config(), quick: bool = False
                       ) -> DataFrame:
    """Factorisation and popularity on the same test truth."""
    c = config.columns
    train, _, test = split.temporal_split(gold, config)
    learn, truth = [recommend.interaction_matrix(part, config) for part in (train, test)]
    recommend.require_int_ids(learn, truth, config=config)
    wanted = truth.select(c.user, F.col(c.category).alias("item"))
    model = recommend.fit_als(learn, config, iterations=3 if quick else None)
    factored = ranking.ranking_metrics(
        recommend.als_rows(model, config=config, users=truth), wanted, config=config,
        users_with_list=model.userFactors.count())
    popular = ranking.shared_list_metrics(
        recommend.popularity_topk(learn, config=config), wanted, config=config)
    return _named("als", factored).unionByName(_named("popularity", popular))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--csv", required=True, help="folder with the three CSV files")
    parser.add_argument("--out", required=True, help="folder for layers and reports")
    parser.add_argument("--quick", action="store_true", help="one grid point, two folds")
    parser.add_argument("--only", help="comma-separated experiments")
    parser.add_argument("--rebuild", action="store_true", help="do not reuse layers")
    parser.add_argument("--grow", action="store_true", help="add dates that the layers lack")
    parser.add_argument("--fraction", type=float, default=1.0, help="share of silver to use")
    parser.add_argument("--no-als", action="store_true")
    parser.add_argument("--weighted", action="store_true")
    parser.add_argument("--learning-curve", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("lagwise").getOrCreate()
    with layers.scope(spark):  # reports are written inside; staged tables go with the run
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    config = Config()
    bronze = build_bronze(spark, args.csv, args.out, config, args.rebuild, args.grow)
    silver = build_silver(spark, bronze, args.out, config, args.rebuild, args.grow)
    origin, out = None, args.out
    if args.fraction < 1:
        # The sample keeps the hours of the whole table, and gets a feature layer of its own.
        origin = silver.agg(F.min(config.columns.time)).first()[0]
        silver = sampling.fraction_of(silver, args.fraction, config, "silver")
        out = f"{args.out}/fraction-{args.fraction:g}"
    gold = build_gold(spark, silver, out, config, args.rebuild, origin, args.grow)
    reports = {
        "cast_audit": contract.audit_cast(*csv_reads(spark, args.csv).values()),
        "layer": layers.layer_footprint(bronze.impressions),
        "split": split.split_summary(gold, config),
        "registry": feat.feature_registry(gold, config),
    } | run_experiments(gold, config, args.only.split(",") if args.only else None, args.quick)
    if args.weighted:
        reports["weighted"] = run_weighted(gold, config)
    if args.learning_curve:
        train, val, _ = split.temporal_split(gold, config)
        best = best_experiment(reports["metrics"])
        reports["learning_curve"] = models.learning_curve(
            sampling.undersample_negatives(train, config), val,
            models.experiments(config)[best], sampling.effective_rate(train, config),
            (0.25, 1.0) if args.quick else (0.1, 0.25, 0.5, 1.0), config)
    if not args.no_als:
        reports["ranking"] = run_recommendation(gold, config, args.quick)
    for name, df in reports.items():
        layers.write_layer(df, f"{out}/reports/{name}")
        print(name)
        spark.read.parquet(f"{out}/reports/{name}").show(60, truncate=False)


if __name__ == "__main__":
    main()
