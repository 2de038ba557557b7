"""Orders without a task that holds them: user ranges, label index, best products, quantiles, layouts."""
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.ml import features as feat
from lagwise.ml import models
from lagwise.operators import fatigue, history, products, quantiles, ranges, recommend, sampling, split
from lagwise.plans import queries as q
from lagwise.plans import run, standins

CONFIG = standins.STANDIN_CONFIG


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def one_second(spark, n: int):
    """``n`` rows of one user in one second, and a few rows of other users around them."""
    return spark.range(n).select(
        F.when(F.col("id") % 1000 == 0, F.col("id") % 7).otherwise(99).alias("userid"),
        F.lit(1_704_200_000).alias("time_stamp"), (F.col("id") * 7919 % 1013).alias("adgroup_id"),
        F.lit("s").alias("pid"), F.col("id").alias("event_id"),
        (F.xxhash64("id") % 5 == 0).cast("int").alias("clk"))


def test_a_million_rows_of_a_second_are_many_tasks(spark):
    df, config = one_second(spark, 1_000_000), Config(hot_user_rows=50_000)
    hot = fatigue.hot_users(df, config)
    assert [(r["_user"]["id"], r["n"]) for r in hot.collect()] == [(99, 999_000)]
    sizes = [r["count"] for r in fatigue.hot_ranges(df, hot, config).groupBy(ranges.PART).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 999_000 / 8
    w = Window.partitionBy("userid").orderBy("time_stamp", "adgroup_id", "pid", "event_id")
    before = F.sum("clk").over(w.rowsBetween(Window.unboundedPreceding, -1))
    plain = df.select("event_id", F.row_number().over(w).cast("bigint").alias("order_seen"),
                      F.coalesce(before, F.lit(0)).alias("clk_prev"),
                      (F.col("time_stamp") - F.lag("time_stamp").over(w)).alias("gap_sec"))
    got = fatigue.with_user_order(df, config).select(*plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_hot_users_with_every_limit_and_layout(spark, sf_dir):
    imp = standins.impressions(spark, sf_dir)
    want = None
    for limit, parts in ((10**9, 3), (0, 3), (5, 1), (20, 11)):
        got = sorted(map(tuple, fatigue.with_user_order(
            imp.repartition(parts), replace(CONFIG, hot_user_rows=limit)).select(
            "event_id", "order_seen", "gap_sec", "clk_prev").collect()))
        want = want or got
        assert got == want


def test_index_of_a_million_labels_has_no_single_task(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), (F.col("id") % 900_001).cast("string")).alias("c"))
    indexed = feat.frequency_index(df, "c")
    assert "SinglePartition" not in plan_of(indexed).split("BroadcastExchange")[0]
    ends = indexed.agg(F.min("label_index"), F.max("label_index"), F.countDistinct("label_index")).first()
    assert tuple(ends) == (0, 900_000, 900_001)
    top = indexed.filter("label_index < 99999").agg(F.min("n"), F.max("label_index")).first()
    assert tuple(top) == (2, 99_998)
    w = Window.partitionBy(F.floor(F.col("label_index") / 1000)).orderBy("label_index")
    wrong = indexed.withColumns({"n0": F.lag("n").over(w), "l0": F.lag("label").over(w)}).filter(
        "n0 < n OR (n0 = n AND l0 >= label)")
    assert wrong.count() == 0


def brute(users, items, k):
    out = set()
    for u, x in users:
        best = sorted((-float(np.dot(x, y)), i) for i, y in items)[:k]
        out |= {(u, r, i, round(-s, 9)) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("items_at_once, block", [(1 << 16, 512), (40, 7), (8, 3)])
def test_best_products_equal_brute_force(spark, monkeypatch, items_at_once, block):
    monkeypatch.setattr(products, "ITEMS", items_at_once)
    monkeypatch.setattr(products, "BLOCK", block)
    rng = np.random.default_rng(4)
    # Whole numbers: many products tie exactly.
    users = [(i, [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(60)] + [(99, [0.0] * 5)]
    items = [(i, [float(x) for x in rng.integers(-3, 4, 5) * (1 + i % 9)]) for i in range(150)]
    schema = "id long, features array<double>"
    found = products.top_products(
        spark.createDataFrame(users + [(7000, None)], schema).repartition(3),
        spark.createDataFrame(items + [(7001, [1.0, None, 1.0, 1.0, 1.0])], schema), 10)
    assert "Cartesian" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    got = {(r["id"], r["rank"], r["item"], round(r["score"], 9)) for r in found.collect()}
    assert got == brute(users, items, 10)


def test_users_stop_early_where_norms_fall(spark, monkeypatch):
    monkeypatch.setattr(products, "BLOCK", 20)
    rng = np.random.default_rng(6)
    items = [(i, [float(x) for x in np.abs(rng.normal(size=6)) / (1 + i)]) for i in range(2000)]
    users = [(i, [float(x) for x in np.abs(rng.normal(size=6))]) for i in range(50)]
    schema = "id long, features array<double>"
    found = products.top_products(spark.createDataFrame(users, schema), spark.createDataFrame(items, schema), 5)
    assert found.agg(F.max("blocks")).first()[0] <= 3
    assert {(r["id"], r["rank"], r["item"], round(r["score"], 9)) for r in found.collect()} == brute(users, items, 5)


def test_best_products_of_few_or_no_items(spark):
    schema = "id long, features array<double>"
    none, two = spark.createDataFrame([], schema), spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    assert products.top_products(two, none, 3).count() == 0
    assert products.top_products(none, two, 3).count() == 0
    assert products.top_products(two, two, 3).count() == 4


@pytest.mark.parametrize("error", [0.2, 0.01, 0.001])
def test_rank_error_with_heavy_ties(spark, monkeypatch, error):
    monkeypatch.setattr(quantiles, "ROWS", 700)
    rng = np.random.default_rng(8)
    values = np.append(rng.normal(size=5000), [0.25, 0.25, 1.5])
    weights = np.append(rng.integers(1, 50, 5000), [90_000, 5, 40_000])
    table = spark.createDataFrame(list(zip(values.tolist(), weights.tolist())) + [(None, 7), (3.0, 0)],
                                  "s double, n long")
    probabilities = [i / 50 for i in range(51)]
    for parts in (1, 13):
        found = quantiles.approximate_quantiles(table.repartition(parts), probabilities, error)
        usable = table.filter("s IS NOT NULL AND n > 0")
        worst = quantiles.rank_errors(usable, found).agg(F.max("rank_error")).first()[0]
        assert worst <= error
        by_p = {round(r["probability"], 2): r["value"] for r in found.collect()}
        assert by_p[0.5] == 0.25 or error == 0.2  # more than a third of all weight


def test_quantiles_of_rows_without_counts_and_of_none(spark):
    table = spark.range(1000).select(F.col("id").cast("double").alias("s"))
    found = quantiles.approximate_quantiles(table, [0.0, 0.5, 1.0], 1e-9, weight=None)
    assert [r["value"] for r in found.orderBy("probability").collect()] == [0.0, 499.0, 999.0]
    none = quantiles.approximate_quantiles(table.filter("s < 0"), [0.5], 0.1, weight=None)
    assert [r["value"] for r in none.collect()] == [None]
    with pytest.raises(ValueError):
        quantiles.approximate_quantiles(table, [0.5], 0.0)


@pytest.mark.parametrize("name", ["lr_full", "rf_full"])
def test_models_do_not_depend_on_the_layout_of_their_rows(spark, sf_dir, name):
    train, _, test = split.temporal_split(q.gold_layer(spark, sf_dir), CONFIG)
    learn, want = sampling.undersample_negatives(train, CONFIG), None
    experiment = models.experiments(CONFIG)[name]
    for parts in (1, 7, 200):
        model = models.fit(learn.repartition(parts, F.rand(parts)), experiment, CONFIG)
        got = {r["event_id"]: r["p_calibrated"] for r in models.scored(model, test).collect()}
        want = want or got
        assert max(abs(want[i] - got[i]) for i in want) <= 1e-12


def test_factors_do_not_depend_on_the_layout_of_the_matrix(spark):
    matrix = spark.range(3000).select((F.col("id") % 97).alias("userid"), (F.col("id") * 31 % 53).alias("cate_id"),
                                      (1 + F.col("id") % 4).cast("double").alias("clicks")).distinct()
    want = None
    for parts in (1, 7, 60):
        model = recommend.fit_als(matrix.repartition(parts, F.rand(parts)), CONFIG, iterations=3)
        got = {r["id"]: r["features"] for r in model.userFactors.collect()}
        want = want or got
        assert max(abs(a - b) for i in want for a, b in zip(want[i], got[i])) <= 1e-5


def test_weighted_contrast(spark, sf_dir):
    out = {r["experiment"]: r for r in run.run_weighted(q.gold_layer(spark, sf_dir), CONFIG).collect()}
    assert set(out) == {"lr_weighted", "lr_undersampled"}
    under, weighted = out["lr_undersampled"], out["lr_weighted"]
    assert under["delta_auc_pr"] == 0 and under["time_ratio"] == 1
    assert weighted["delta_auc_pr"] == pytest.approx(weighted["auc_pr"] - under["auc_pr"])
    assert weighted["d1_lift"] > 0 and weighted["time_ratio"] > 0


def test_short_ranges_do_not_make_tasks(spark):
    df, config = one_second(spark, 200_000), Config(hot_user_rows=20)
    rows = fatigue.hot_ranges(df, fatigue.hot_users(df, config), config)
    sizes = [r["count"] for r in rows.groupBy(ranges.PART).count().collect()]
    assert len(sizes) >= 199_000 / 20 and max(sizes) <= 20
    assert len(rows.inputFiles()) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_ties = one_second(spark, 5_000).withColumn("event_id", F.lit(0))  # equal rows stay together
    got, whole = [sorted(map(tuple, fatigue.with_user_order(with_ties, replace(config, hot_user_rows=n)).select(
        "userid", "adgroup_id", "event_id", "clk_prev").collect())) for n in (20, 10**9)]
    assert got == whole


@pytest.mark.parametrize("limit", [10**9, 1_000, 200])
def test_histories_in_tasks_of_bounded_size(spark, monkeypatch, limit):
    """A third of the rows are of one entity, others of none, some have no day."""
    monkeypatch.setattr(history, "TASK_ROWS", limit)
    df = spark.range(6_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.xxhash64("id") % 900).alias("e"),
        F.when(F.col("id") % 41 != 0, F.date_add(F.lit("2024-01-01"), (F.col("id") % 29).cast("int"))).alias("d"),
        (F.xxhash64("id") % 3 == 0).cast("int").alias("clk"))
    config = Config(entities=("e",))
    totals = history.daily_totals(df, ["e", "d"], config, df.count())
    assert sorted(map(repr, totals.collect())) == sorted(map(repr, history.daily_totals(
        df, ["e", "d"], config).collect()))
    if limit < 10**9:  # as many tasks as the rows ask for, whatever the session's number is
        assert max(8, 6_000 // limit) <= history._dealt(df, "e", 60_000).rdd.getNumPartitions()
        sizes = df.join(history._hot_buckets(df, "e", 6_000), F.pmod(F.xxhash64("e"), F.lit(
            1 << 16)) == F.col("_bucket"), "left_semi").select("e").distinct().collect()
        assert [r["e"] for r in sizes] == [7]
    got, want = [history.with_entity_history(df, config, counts=True, combined=c).select(
        "event_id", "imp_prev_e", "clk_prev_e", F.round("ctr_hist_e", 9), "p0") for c in (False, True)]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_many_training_rows_make_more_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "TRAIN_ROWS", 100)
    df = spark.range(2_000).select(F.col("id").alias("event_id"), F.lit(1).alias("clk"))
    with models.held(df) as rows:
        sizes = [len(p) for p in rows.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) < 200
