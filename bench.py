"""Headline timings: the stages of a full run, then queries on the largest table.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]; prints one JSON line.
"""
from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise.ml import models
from lagwise.operators import leakage, metrics, quality, sampling, split
from lagwise.operators.gold import gold_columns, gold_features
from lagwise.plans import queries as q
from lagwise.plans import run, standins
from lagwise.sources import contract, layers
from tests.session import make_session

CONFIG = standins.STANDIN_CONFIG
QUERIES = ("deferred_entity_ctr_volume", "entity_history_volume", "deferred_entity_ctr",
           "user_fatigue", "slot_rolling_ctr", "binary_metrics", "score_deciles",
           "ranking_metrics", "score_quantiles", "product_topk", "frequency_index")
#: All grid points of each, on the search sample of the training rows. The long ones come last and
#: start only within this many seconds, so that the figures before them are always printed.
SEARCHES, LAST_START = ("lr_full", "rf_full", "gbt_full"), 400


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_session()
    seconds: dict[str, float] = {}

    failed: dict[str, str] = {}

    def timed(name: str, work: Callable):
        """Runs a stage; one that fails is noted, and those that need its result fail as well."""
        start = time.perf_counter()
        try:
            result = work()
            if isinstance(result, DataFrame):
                consume(result)
        except Exception as e:  # what was measured so far is still printed
            failed[name] = f"{type(e).__name__}: {e}"[:300]
            return None
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    # Set-up, not timed: the impression table as the CSV text a run starts from.
    csv, out = layers.fresh_path(spark, "bench-csv"), layers.fresh_path(spark, "bench")
    raw = standins.impressions(spark, sf_dir).withColumnRenamed("userid", "user").drop("d")
    raw.write.option("header", True).csv(csv)
    ads, profiles = standins.ads(spark, sf_dir), standins.profiles(spark, sf_dir)
    day = CONFIG.columns.day

    def bronze() -> DataFrame:
        types = dict(contract.IMPRESSIONS.types) | {"event_id": "bigint"}
        declared = contract.TableContract("raw_sample", types, contract.IMPRESSIONS.required)
        return layers.build_layer(
            spark, f"{out}/impressions", ["event_id", "d"],
            lambda: run.ingest_impressions(contract.read_csv(spark, declared, csv).typed, CONFIG),
            day)

    start = time.perf_counter()
    imp = timed("bronze", bronze)
    timed("quality_profile", lambda: quality.imputation_decision(
        quality.missingness_profile(imp, profiles, CONFIG), CONFIG))
    silver = timed("silver", lambda: run.build_silver(
        spark, run.Bronze(imp, ads, profiles), out, CONFIG))
    gold = timed("gold", lambda: layers.build_layer(
        spark, f"{out}/gold", gold_columns(CONFIG), lambda: gold_features(silver, CONFIG), day))
    timed("leak_checks", lambda: leakage.require_leak_free(gold, CONFIG))
    try:
        judged(gold, timed)
    except Exception as e:
        failed["judged"] = f"{type(e).__name__}: {e}"[:300]
    timed("volume_layer", lambda: q.volume_layer(spark, sf_dir).limit(0))
    for name in QUERIES:
        timed(name, lambda name=name: q.queries()[name](spark, sf_dir))
    if gold is not None:
        learn = sampling.undersample_negatives(split.temporal_split(gold, CONFIG)[0], CONFIG)
        for name in SEARCHES:
            if time.perf_counter() - start < LAST_START:
                timed(f"search_{name}", lambda name=name: models.tune(
                    learn, models.experiments(CONFIG)[name], CONFIG).best)
            else:
                failed[f"search_{name}"] = f"not started: over {LAST_START} s before it"
    total = time.perf_counter() - start
    print(json.dumps({
        "metric": "total_seconds", "value": round(total, 3), "unit": "sec", "queries": seconds,
        "failed": failed, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": os.environ.get("BENCH_CPUS", "8"), "impressions": imp.count() if imp is not None else None,
        "order_lines": standins.table(spark, sf_dir, "lineitem").count(),
    }))


def judged(gold: DataFrame, timed: Callable) -> None:
    """The stages that fit and judge models."""
    train, val, test = split.temporal_split(gold, CONFIG)
    learn = sampling.undersample_negatives(train, CONFIG)
    timed("undersampling", lambda: learn.agg(F.count(F.lit(1))))
    rate = sampling.effective_rate(train, CONFIG)
    catalogue = models.experiments(CONFIG)
    judged_on_test = {}
    for name in ("lr_context", "lr_full", "rf_full", "gbt_full"):
        def refit(name: str = name) -> DataFrame:
            scores = metrics.score_table(models.scored(
                models.fit(learn, catalogue[name], CONFIG), test, rate), config=CONFIG)
            judged_on_test[name] = scores
            return scores

        timed(f"refit_{name}", refit)
    timed("search_lr_context", lambda: models.tune(learn, catalogue["lr_context"], CONFIG).best)
    timed("lr_weighted", lambda: run.run_weighted(gold, CONFIG))
    areas = {name: metrics.auc(scores, config=CONFIG).first()["auc_pr"] or 0.0
             for name, scores in judged_on_test.items()}
    best = max(sorted(areas), key=areas.get)
    timed("learning_curve_best", lambda: models.learning_curve(
        learn, val, catalogue[best], rate, config=CONFIG))
    timed("als", lambda: run.run_recommendation(gold, CONFIG))


if __name__ == "__main__":
    main()
