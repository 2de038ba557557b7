"""Hand-computed cases for every window, metric, rule and gate."""
import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Columns, Config, Splits
from lagwise.errors import ContractError, DataQualityError
from lagwise.functions import columns as fn
from lagwise.operators import (enrich, fatigue, history, leakage, metrics, quality, ranking,
                               recommend, sampling, split)
from lagwise.operators.gold import gold_features
from lagwise.operators.ingest import ingest_impressions, with_time_features
from lagwise.plans import queries as q
from lagwise.plans import standins
from lagwise.sources import contract, layers

CONFIG = standins.STANDIN_CONFIG
DAY = dt.date(2024, 1, 1)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def days(n):
    return DAY + dt.timedelta(days=n)


# --- columns ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("gap, bucket", [
    (None, "primera"), (0, "0-5min"), (300, "0-5min"), (301, "5-60min"), (3600, "5-60min"),
    (3601, "1-24h"), (86400, "1-24h"), (86401, "mas_1d")])
def test_gap_buckets_include_their_upper_bound(spark, gap, bucket):
    assert value(spark, fn.gap_bucket(F.lit(gap).cast("bigint"))) == bucket


@pytest.mark.parametrize("hour, part", [(0, "madrugada"), (5, "madrugada"), (6, "manana"),
                                        (11, "manana"), (12, "tarde"), (18, "tarde"),
                                        (19, "noche"), (23, "noche")])
def test_day_parts(spark, hour, part):
    assert value(spark, fn.day_part(F.lit(hour))) == part


def test_prior_correction_recovers_the_true_rate(spark):
    sampled = 0.05 / (0.05 + 0.1 * 0.95)
    assert round(sampled, 6) == 0.344828
    assert math.isclose(value(spark, fn.corrected_probability(F.lit(sampled), 0.1)), 0.05)
    assert math.isclose(value(spark, fn.corrected_probability(F.lit(0.3), 1.0)), 0.3)
    corrected = [value(spark, fn.corrected_probability(F.lit(p), 0.2)) for p in (.1, .4, .8)]
    assert corrected == sorted(corrected) and all(
        c < p for c, p in zip(corrected, (.1, .4, .8)))


def test_smoothed_rate_of_an_unseen_entity_is_the_prior(spark):
    assert value(spark, fn.smoothed_rate(F.lit(0), F.lit(0), F.lit(0.07), 200)) == \
        pytest.approx(0.07)
    assert value(spark, fn.smoothed_rate(F.lit(1), F.lit(2), F.lit(None).cast("double"), 200)) \
        is None


def test_two_proportion_z(spark):
    def z(*counts):
        return value(spark, fn.two_proportion_z(*map(F.lit, counts)))
    assert z(81_546, 1_528_526, 1_284_559, 25_029_435) > 10
    assert z(0, 0, 5, 10) is None
    assert z(0, 5, 0, 10) is None


def test_correlation_ignores_nulls_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 1, 0.1), (2.0, 1, 0.1), (3.0, 0, 0.1), (None, 0, 0.1)],
                               "x double, y int, c double")
    row = df.agg(fn.correlation(F.col("x"), F.col("y")).alias("r"),
                 fn.correlation(F.col("c"), F.col("y")).alias("const")).first()
    assert row["r"] == pytest.approx(-0.8660254)
    assert row["const"] is None


def test_fractions_are_nested_and_layout_free(spark):
    df = spark.range(20_000).withColumnRenamed("id", "event_id")
    small, large = fn.in_fraction(F.col("event_id"), 0.1, 42, "a"), fn.in_fraction(
        F.col("event_id"), 0.5, 42, "a")
    rows = df.select("event_id", small.alias("s"), large.alias("l")).collect()
    assert all(r["l"] for r in rows if r["s"])
    assert 1800 < sum(r["s"] for r in rows) < 2200
    again = df.repartition(3).filter(small).count()
    assert again == sum(r["s"] for r in rows)
    assert df.filter(fn.in_fraction(F.col("event_id"), 0.1, 7, "a")).count() != again
    with pytest.raises(ValueError):
        fn.in_fraction(F.col("event_id"), 1.5, 42, "a")


# --- time -----------------------------------------------------------------------------------------------

def test_time_features_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1_494_000_000,), (1_494_086_399,)], "time_stamp bigint")
    def rows():
        full = with_time_features(df).withColumn("back", fn.epoch_seconds(F.col("ts_utc_s")))
        assert full.filter("back <> time_stamp").count() == 0
        return [tuple(r) for r in full.orderBy("time_stamp").collect()]
    zone = spark.conf.get("spark.sql.session.timeZone")
    before = rows()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert rows() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    first = with_time_features(df).orderBy("time_stamp").first()
    assert first["ts_utc_s"] == dt.datetime(2017, 5, 5, 16)
    assert first["d"] == dt.date(2017, 5, 6) and first["hour"] == 0
    assert first["day_part"] == "madrugada" and first["dow"] == 7 and first["weekend"] == 1


def test_row_id_comes_from_the_content(spark):
    """From all of it but the outcome: rows that differ in nothing else share an id."""
    df = spark.createDataFrame([(1, 10, 5, "a", 0), (1, 10, 5, "a", 1), (1, 10, 5, "b", 0)],
                               "user bigint, time_stamp bigint, adgroup_id bigint, pid string, "
                               "clk int")
    ids = [r["event_id"] for r in ingest_impressions(df).collect()]
    assert len(set(ids)) == 2
    assert sorted(ids) == sorted(
        r["event_id"] for r in ingest_impressions(df.repartition(3)).collect())


# --- contract and layers --------------------------------------------------------------------------------

DIRTY = ("﻿UserID,cms_segid,cms_group_id,final_gender_code,age_level,pvalue_level,"
         "shopping_level,occupation,new_user_class_level ,extra\n"
         "1,5,2,1,3,NULL,3,0,2.0,x\n2,5.0,2,1,3,,3,0,,x\n3,5.5,x,1,3,1.0,3,0,1,x\n")


def test_contract_reads_a_dirty_file(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(DIRTY, encoding="utf-8")
    read = contract.read_csv(spark, contract.PROFILES, str(path))
    assert read.typed.columns == list(contract.PROFILES.types)
    assert dict(read.typed.dtypes) == contract.PROFILES.types
    rows = {r["userid"]: r for r in read.typed.collect()}
    assert rows[1]["pvalue_level"] is None and rows[1]["new_user_class_level"] == 2.0
    assert rows[2]["cms_segid"] == 5 and rows[3]["cms_segid"] == 5
    assert rows[3]["cms_group_id"] is None
    assert "new_user_class_level " in read.renamed
    audit = {r["column_name"]: r for r in contract.audit_cast(read).collect()}
    assert (audit["pvalue_level"]["nulls_before"], audit["pvalue_level"]["created_by_cast"]) \
        == (1, 1)
    assert audit["cms_group_id"]["created_by_cast"] == 1
    assert audit["userid"]["nulls_after"] == 0


def test_contract_refuses_a_missing_required_column(spark):
    raw = spark.createDataFrame([("1", "2")], "adgroup_id string, cate_id string")
    with pytest.raises(ContractError, match="campaign_id"):
        contract.apply_contract(raw, contract.ADS)


def test_contract_tolerates_a_missing_optional_column(spark):
    names = [c for c in contract.ADS.types if c != "brand"]
    raw = spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"{n} string" for n in names))
    read = contract.apply_contract(raw, contract.ADS)
    assert read.missing == ("brand",) and "brand" not in read.typed.columns


def test_a_layer_grows_by_dates_and_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "layer")

    def grown(rows, stamp="s"):
        df = spark.createDataFrame(rows, "x bigint, d date")
        return layers.build_layer(spark, path, ["x", "d"], lambda: df, "d", stamp=stamp, grow=True)

    def files():
        return {f: f.stat().st_mtime_ns for f in tmp_path.glob("layer/*/*.parquet")}

    grown([(1, DAY), (2, None)])
    before = files()
    again = grown([(9, DAY), (9, None), (3, days(1)), (4, days(2))])  # held dates are final
    assert sorted((r["x"], str(r["d"])) for r in again.collect()) == [
        (1, str(DAY)), (2, "None"), (3, str(days(1))), (4, str(days(2)))]
    assert before.items() <= files().items() and len(files()) == 4
    before = files()
    assert grown([(9, DAY)]).count() == 4 and files() == before  # nothing new: nothing is written
    assert grown([], "s").count() == 4
    assert [r["x"] for r in grown([(7, DAY)], "other").collect()] == [7]  # other settings: a rebuild


def test_layers_are_reused_until_the_contract_breaks(spark, tmp_path):
    path, built = str(tmp_path / "layer"), []

    def build(n):
        built.append(n)
        return spark.createDataFrame([(n, DAY), (n, days(1))], "x bigint, d date")
    layers.build_layer(spark, path, ["x", "d"], lambda: build(1), "d")
    again = layers.build_layer(spark, path, ["x", "d"], lambda: build(2), "d")
    assert built == [1] and {r["x"] for r in again.collect()} == {1}
    assert dict(again.dtypes)["d"] == "date"
    assert layers.layer_partitions(again, "d").count() == 2
    foot = layers.layer_footprint(again).first()
    assert foot["rows"] == 2 and foot["files"] == 2 and foot["bytes"] > 0
    layers.build_layer(spark, path, ["x"], lambda: build(3), "d", rebuild=True)
    assert built == [1, 3]
    with pytest.raises(ContractError):
        layers.build_layer(spark, path, ["x", "y"], lambda: build(4), "d")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert layers.shared_folder(spark) == named.rstrip("/")
    staged = layers.staged(spark.range(5), "five")
    assert staged.count() == 5 and "parquet" in staged.inputFiles()[0]


# --- joins and quality ----------------------------------------------------------------------------------

def _facts(spark):
    return spark.createDataFrame(
        [(1, 10, 1), (2, 10, 0), (3, 11, 0)], "userid bigint, adgroup_id bigint, clk int")


def test_join_check_sees_duplicates_and_losses(spark):
    ads = spark.createDataFrame([(10,), (10,), (11,)], "adgroup_id bigint")
    users = spark.createDataFrame([(1,), (2,), (3,)], "userid bigint")
    rows = {r["check"]: r for r in quality.join_cardinality(_facts(spark), ads, users).collect()}
    assert (rows["inner_ads"]["rows"], rows["inner_ads"]["verdict"]) == (5, fv.DUPLICATES)
    assert rows["inner_ads_left_profiles"]["rows"] == 5
    assert rows["ads_key_unique"]["verdict"] == fv.KEY_NOT_UNIQUE
    assert rows["profiles_key_unique"]["verdict"] == fv.OK
    ads = spark.createDataFrame([(10,)], "adgroup_id bigint")
    checks = quality.join_cardinality(_facts(spark), ads, users)
    lost = {r["check"]: r for r in checks.collect()}["inner_ads"]
    assert (lost["delta"], lost["verdict"]) == (-1, fv.LOSES_ROWS)
    with pytest.raises(DataQualityError, match=fv.LOSES_ROWS):
        quality.require_all_ok(checks, "joins")


@pytest.mark.parametrize("pct, z, decision", [
    (0.0, None, fv.NO_ACTION), (0.5, 0.1, fv.DROP_ROWS), (0.5, -4.0, fv.KEEP_UNKNOWN),
    (1.0, 0.0, fv.DROP_ROWS), (3.0, 0.9, fv.IMPUTE_MODE), (3.0, 3.5, fv.KEEP_UNKNOWN),
    (5.0, 3.0, fv.IMPUTE_MODE), (5.1, 0.0, fv.KEEP_UNKNOWN), (40.0, None, fv.KEEP_UNKNOWN)])
def test_imputation_rule(spark, pct, z, decision):
    profile = spark.createDataFrame([(pct, int(pct > 0), z)],
                                    "pct_null double, n_null bigint, z double")
    assert quality.imputation_decision(profile).first()["decision"] == decision


def test_imputation_actions(spark):
    df = spark.createDataFrame([(1, None, 5.0, 1), (2, 3, None, 1), (None, 3, 5.0, 2),
                                (4, 7, 5.0, None), (5, 7, 6.0, 3)],
                               "a int, b int, c double, e int")
    out = quality.apply_imputation(df, {"a": fv.DROP_ROWS, "b": fv.IMPUTE_MODE,
                                        "c": fv.KEEP_UNKNOWN, "e": fv.NO_ACTION}).collect()
    assert sorted((r["a"], r["b"], r["c"], r["e"] or -9) for r in out) == [
        (1, 7, 5, 1), (2, 3, -1, 1), (4, 7, 5, -9), (5, 7, 6, 3)]


def test_flags_and_sentinel(spark):
    ads = spark.createDataFrame([(10, None, 0.0), (11, 2.0, None)],
                                "adgroup_id bigint, brand double, price double")
    rows = {r["adgroup_id"]: r for r in enrich.with_ad_flags(ads).collect()}
    assert rows[10]["brand_known"] == 0 and rows[10]["price_valid"] == 0
    assert rows[11]["brand_known"] == 1 and rows[11]["price_valid"] is None


# --- point-in-time windows ------------------------------------------------------------------------------

def test_user_order_with_ties_gaps_and_slices(spark):
    rows = [  # userid, time_stamp, adgroup_id, pid, event_id, clk
        (1, 100, 5, "a", 2, 1), (1, 100, 5, "a", 1, 0), (1, 100, 4, "b", 3, 1),
        (1, 4000, 5, "a", 4, 0), (1, 90_000, 5, "a", 5, 1), (2, 50, 5, "a", 6, 0),
        (None, 10, 5, "a", 7, 1), (None, 9000, 5, "a", 8, 0)]
    df = spark.createDataFrame(rows, "userid bigint, time_stamp bigint, adgroup_id bigint, "
                                     "pid string, event_id bigint, clk int")
    expected = {3: (1, None, 0), 1: (2, 0, 1), 2: (3, 0, 1), 4: (4, 3900, 2), 5: (5, 86_000, 2),
                6: (1, None, 0), 7: (1, None, 0), 8: (2, 8990, 1)}
    for limit in (100, 0, 1, 2, 4):
        config = Config(hot_user_rows=limit)
        got = {r["event_id"]: (r["order_seen"], r["gap_sec"], r["clk_prev"])
               for r in fatigue.with_user_order(df, config).collect()}
        assert got == expected, limit


def test_user_order_equals_a_plain_window_on_any_layout(spark, sf_dir):
    from pyspark.sql import Window
    imp = standins.impressions(spark, sf_dir)
    # One user holds a third of all rows.
    imp = imp.withColumn("userid", F.when(F.col("event_id") % 3 == 0, 7).otherwise(
        F.col("userid")))
    w = Window.partitionBy("userid").orderBy("time_stamp", "adgroup_id", "pid", "event_id")
    plain = imp.select("event_id", F.row_number().over(w).cast("bigint"),
                       F.col("time_stamp") - F.lag("time_stamp").over(w),
                       F.coalesce(F.sum("clk").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)))
    expected = {tuple(r) for r in plain.collect()}
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for limit in (10_000, 100):
                config = replace(CONFIG, hot_user_rows=limit)
                assert fatigue.hot_users(imp, config).count() == (limit == 100)
                got = fatigue.with_user_order(imp.repartition(5), config).select(
                    "event_id", "order_seen", "gap_sec", "clk_prev")
                assert {tuple(r) for r in got.collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_slot_rate_uses_elapsed_hours_not_rows(spark):
    rows = [("a", 0, 1), ("a", 0, 0), ("a", 2, 1), ("a", 9, 0), ("a", 10, 0), ("b", 3, 1)]
    df = spark.createDataFrame([(s, h * 3600, k) for s, h, k in rows],
                               "pid string, time_stamp bigint, clk int")
    got = {(r["pid"], r["hour_idx"]): r["ctr_6h"] for r in history.slot_hour_rates(df).collect()}
    assert got == {("a", 0): None, ("a", 2): 0.5, ("a", 9): None, ("a", 10): 0.0, ("b", 3): None}
    shifted = history.slot_hour_rates(df, origin=-3600)
    assert {r["hour_idx"] for r in shifted.collect()} == {1, 3, 4, 10, 11}


def test_history_is_strictly_earlier_days(spark):
    rows = [("x", days(0), 1), ("x", days(0), 0), ("x", days(2), 1), ("y", days(2), 0),
            (None, days(2), 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "event_id bigint, e string, d date, clk int")
    config = Config(entities=("e",))
    out = {r["event_id"]: r for r in
           history.with_entity_history(df, config, counts=True).collect()}
    direct = history.with_entity_history(df, config, counts=True, combined=False)
    assert {r["event_id"]: r for r in direct.select(*out[0].asDict()).collect()} == out
    assert len(out) == 5
    assert out[0]["p0"] is None and out[0]["ctr_hist_e"] is None
    assert out[2]["p0"] == 0.5 and (out[2]["imp_prev_e"], out[2]["clk_prev_e"]) == (2, 1)
    assert out[2]["ctr_hist_e"] == pytest.approx((1 + 200 * 0.5) / 202)
    assert out[3]["ctr_hist_e"] == pytest.approx(0.5) and out[3]["log_imp_hist_e"] == 0
    assert out[4]["ctr_hist_e"] is None and out[4]["p0"] == 0.5


def test_price_reference_comes_from_training_days(spark):
    config = Config(splits=Splits(burn_in=days(0), train_start=days(1), train_end=days(1)))
    df = spark.createDataFrame(
        [(1, days(1), 1, 10.0), (2, days(1), 1, 30.0), (3, days(5), 1, 1000.0),
         (4, days(5), 2, 5.0), (5, days(1), 3, 0.0), (6, days(1), 1, None)],
        "event_id bigint, d date, cate_id bigint, price double")
    got = {r["event_id"]: r["price_rel"]
           for r in history.with_price_relative(df, config).collect()}
    assert got == {1: 0.5, 2: 1.5, 3: 50.0, 4: 1.0, 5: 1.0, 6: 1.0}


def test_later_labels_never_move_earlier_features(spark, sf_dir):
    """The leak test proper: flip every label from a day on; features up to it must not move."""
    silver = q.build_silver(spark, sf_dir)
    day = F.lit(dt.date(2024, 1, 15))
    flipped = silver.withColumn("clk", F.when(F.col("d") >= day, 1 - F.col("clk"))
                                .otherwise(F.col("clk")))
    entity_features = [*CONFIG.history_features]
    def rows(df, upto):
        gold = gold_features(df, CONFIG).filter(upto)
        return {r["event_id"]: tuple(r) for r in gold.select(
            "event_id", *entity_features, "price_rel").collect()}
    assert rows(silver, F.col("d") <= day) == rows(flipped, F.col("d") <= day)
    before = F.col("d") < day
    def everything(df):
        return {r["event_id"]: tuple(r) for r in gold_features(df, CONFIG).filter(before).collect()}
    assert everything(silver) == everything(flipped)


def test_leak_checks_catch_a_window_left_open(spark, sf_dir):
    gold = q.gold_layer(spark, sf_dir)
    assert {r["verdict"] for r in leakage.leak_checks(gold, CONFIG).collect()} == {fv.OK}
    leakage.require_leak_free(gold, CONFIG)
    open_window = gold.withColumn("ctr_hist_pid", F.col("ctr_hist_pid") + 0.001 * F.col("clk"))
    with pytest.raises(DataQualityError, match="recompute"):
        leakage.require_leak_free(open_window, CONFIG)
    answer = gold.withColumn("log_gap", F.col("clk").cast("double"))
    bad = leakage.feature_correlations(answer, CONFIG).filter(F.col("verdict") == fv.LEAK)
    assert [r["feature"] for r in bad.collect()] == ["log_gap"]


# --- split and sampling ---------------------------------------------------------------------------------

def test_split_leaves_the_burn_in_out(spark):
    config = Config()
    df = spark.createDataFrame([(dt.date(2017, 5, n), n % 2) for n in range(5, 16)],
                               "d date, clk int")
    train, val, test = split.temporal_split(df, config)
    assert sorted(r["d"].day for r in train.collect()) == [7, 8, 9, 10, 11]
    assert [r["d"].day for r in val.collect()] == [12]
    assert [r["d"].day for r in test.collect()] == [13]
    labels = {r["d"].day: r["split"] for r in split.split_summary(df, config).collect()}
    assert labels[6] == fv.SPLIT_BURN_IN and labels[5] == labels[15] == fv.SPLIT_OUTSIDE


def test_undersampling_keeps_every_positive(spark, sf_dir):
    imp = standins.impressions(spark, sf_dir)
    kept = sampling.undersample_negatives(imp, CONFIG)
    assert kept.filter("clk = 1").count() == imp.filter("clk = 1").count()
    rate = sampling.effective_rate(imp, CONFIG)
    assert 0.05 < rate < 0.15
    balance = sampling.class_balance(imp, CONFIG).first()
    assert balance["rows_kept"] == kept.count()
    assert balance["prevalence_sample"] > balance["prevalence_real"]


def test_a_sample_of_a_sample_keeps_the_balance(spark):
    df = spark.range(40_000).select(F.col("id").alias("event_id"),
                                    (F.col("id") % 2).cast("int").alias("clk"))
    learn = sampling.undersample_negatives(df)
    before = learn.filter("clk = 1").count() / learn.count()
    for purpose in ("search", "curve"):
        part = sampling.fraction_of(learn, 0.2, purpose=purpose)
        assert 0.18 < part.count() / learn.count() < 0.22
        assert abs(part.filter("clk = 1").count() / part.count() - before) < 0.02


def test_class_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "clk int")
    total = sampling.with_class_weights(df).groupBy("clk").agg(F.sum("weight").alias("w"))
    assert {r["w"] for r in total.collect()} == {3.0}
    assert sampling.positive_weight(df.filter("clk = 0")).first()["weight"] == 1.0


# --- metrics --------------------------------------------------------------------------------------------

def _pred(spark, scores, labels):
    return spark.createDataFrame([(float(s), y) for s, y in zip(scores, labels)],
                                 "p_calibrated double, clk int")


def test_auc_with_a_tie_and_of_a_constant(spark):
    pred = _pred(spark, [.9, .8, .7, .6, .6, .2], [1, 0, 1, 0, 1, 0])
    row = metrics.auc(pred).first()
    assert row["auc_roc"] == pytest.approx(0.722222, abs=1e-6)
    assert row["auc_pr"] == pytest.approx(0.738889, abs=1e-6)
    flat = metrics.auc(_pred(spark, [.3] * 4, [1, 0, 0, 0])).first()
    assert (flat["auc_roc"], flat["auc_pr"]) == (0.5, 0.25)
    no_positive = metrics.auc(_pred(spark, [.3, .4], [0, 0])).first()
    assert no_positive["auc_roc"] is None and no_positive["auc_pr"] is None


def test_auc_equals_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    pred = spark.range(900).select(
        (F.pmod(F.xxhash64("id"), F.lit(997)) / 997.0).alias("p_calibrated"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).cast("int").alias("clk"))
    row = metrics.auc(pred).first()
    for name, column in (("areaUnderROC", "auc_roc"), ("areaUnderPR", "auc_pr")):
        ev = BinaryClassificationEvaluator(labelCol="clk", rawPredictionCol="p_calibrated",
                                           metricName=name, numBins=0)
        assert row[column] == pytest.approx(ev.evaluate(pred), abs=1e-9)


def test_binary_metrics_of_a_perfect_and_a_constant_score(spark):
    perfect = metrics.binary_metrics(_pred(spark, [1, 1, 0, 0], [1, 1, 0, 0])).first()
    assert perfect["auc_roc"] == perfect["auc_pr"] == 1.0
    assert perfect["logloss"] == perfect["brier"] == 0.0
    flat = metrics.binary_metrics(_pred(spark, [.25] * 4, [1, 0, 0, 0])).first()
    assert flat["calibration_bias"] == flat["auc_pr_lift"] == 1.0
    assert flat["brier"] == pytest.approx(0.1875)


def test_missing_scores_are_an_error(spark):
    pred = spark.createDataFrame([(None, 1), (0.5, 0)], "p_calibrated double, clk int")
    with pytest.raises(Exception, match="NULL in p_calibrated"):
        metrics.auc(pred).collect()


def test_deciles_of_a_score_table_count_rows(spark):
    scores = [.1] * 40 + [.2] * 30 + [.3] * 20 + [.4, .5, .6, .7, .8, .9] + [.95] * 4
    pred = _pred(spark, scores, [1, 0] * 50)
    want = metrics.score_deciles(pred).collect()
    table = metrics.score_table(pred)
    assert metrics.score_deciles(table, relative_error=0.001).collect() == want


def test_deciles(spark):
    pred = _pred(spark, [i / 100 for i in range(100)], [int(i >= 90) for i in range(100)])
    for relative_error in (None, 0.001):
        rows = metrics.score_deciles(pred, relative_error=relative_error).collect()
        rows = sorted(rows, key=lambda r: int(r["decile"][1:]))
        assert [r["decile"] for r in rows] == [f"D{i}" for i in range(1, 11)]
        assert rows[0]["lift"] > 8 and sum(r["impressions"] for r in rows) == 100
    flat = metrics.score_deciles(_pred(spark, [.5] * 20, [1, 0] * 10)).collect()
    assert [(r["decile"], r["impressions"], r["lift"]) for r in flat] == [("D1", 20, 1.0)]


def test_exact_quantiles_interpolate(spark):
    counts = metrics.score_table(_pred(spark, [.1, .2, .2, .4], [0, 0, 0, 0]))
    row = metrics.exact_quantiles(counts, [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    assert [round(v, 10) for v in row] == [0.1, 0.175, 0.2, 0.34, 0.4]


def test_pr_curve(spark):
    rows = metrics.pr_curve(_pred(spark, [.99, .5, .5, 1.0], [1, 0, 1, 1]), points=10) \
        .orderBy(F.col("threshold").desc()).collect()
    assert [(r["threshold"], r["n_cum"], r["precision"], r["recall"]) for r in rows] == [
        (0.9, 2, 1.0, 0.666667), (0.5, 4, 0.75, 1.0)]
    none = metrics.pr_curve(_pred(spark, [.5], [0])).first()
    assert none["recall"] == 0.0


def test_ranking_metrics_by_hand(spark):
    lists = spark.createDataFrame([(1, [1, 2, 3]), (5, [9])], "userid bigint, l array<bigint>")
    truth = spark.createDataFrame([(1, 2), (1, 9), (1, 9), (8, 1)], "userid bigint, item bigint")
    row = ranking.ranking_metrics(ranking.list_rows(lists, "userid", "l"), truth, 10).first()
    assert (row["users_evaluated"], row["users_with_truth"], row["users_with_list"]) == (1, 2, 2)
    assert row["coverage_pct"] == 50.0
    assert (row["precision_at_k"], row["recall_at_k"], row["map_at_k"], row["ndcg_at_k"]) == (
        0.1, 0.5, 0.25, 0.386853)


def test_ranking_equals_mllib(spark):
    from pyspark.ml.evaluation import RankingEvaluator
    lists = spark.createDataFrame([(u, [(u * 7 + i * 3) % 23 for i in range(5)])
                                   for u in range(40)], "userid bigint, l array<bigint>")
    truth = spark.createDataFrame([(u, (u * 5 + j * 2) % 23) for u in range(40)
                                   for j in range(1 + u % 4)], "userid bigint, item bigint")
    row = ranking.ranking_metrics(ranking.list_rows(lists, "userid", "l"), truth, 5).first()
    both = truth.groupBy("userid").agg(F.collect_set("item").alias("t")).join(lists, "userid") \
        .select(F.col("l").cast("array<double>").alias("prediction"),
                F.col("t").cast("array<double>").alias("label"))
    for name, column in (("precisionAtK", "precision_at_k"), ("recallAtK", "recall_at_k"),
                         ("meanAveragePrecisionAtK", "map_at_k"), ("ndcgAtK", "ndcg_at_k")):
        ev = RankingEvaluator(metricName=name, k=5)
        assert row[column] == pytest.approx(ev.evaluate(both), abs=1e-6)


def test_popularity_breaks_ties_by_item(spark):
    matrix = spark.createDataFrame([(1, 7, 2.0), (2, 3, 2.0), (2, 9, 5.0)],
                                   "userid bigint, cate_id bigint, clicks double")
    top = recommend.popularity_topk(matrix, 2).orderBy("rank").collect()
    assert [(r["rank"], r["item"], r["clicks"]) for r in top] == [(1, 9, 5.0), (2, 3, 2.0)]
    lists = recommend.popularity_lists(matrix, matrix, 2).collect()
    assert sorted((r["userid"], r["recommended"]) for r in lists) == [(1, [9, 3]), (2, [9, 3])]


def test_ids_beyond_32_bits_stop_the_factorisation(spark):
    matrix = spark.createDataFrame([(3_000_000_000, 7, 2.0)],
                                   "userid bigint, cate_id bigint, clicks double")
    with pytest.raises(DataQualityError, match="userid"):
        recommend.fit_als(matrix)


def test_roles_can_be_renamed(spark, sf_dir):
    config = Config(columns=Columns(user="u", time="t", ad="a", slot="p", day="day", label="y",
                                    row_id="id"))
    imp = standins.impressions(spark, sf_dir).withColumnsRenamed(
        {"userid": "u", "time_stamp": "t", "adgroup_id": "a", "pid": "p", "d": "day", "clk": "y",
         "event_id": "id"})
    got = fatigue.with_user_order(imp, config)
    assert got.count() == imp.count()
