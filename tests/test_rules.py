"""Rules that small tables do not reach by themselves."""
import pytest
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.config import Config
from lagwise.errors import DataQualityError
from lagwise.functions.columns import correlation
from lagwise.operators import fatigue, history, ingest, leakage, metrics, quality, recommend
from lagwise.plans.standins import STANDIN_CONFIG as CONFIG
from lagwise.sources import contract, layers


def _rows(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, userid bigint, time_stamp bigint, "
                                 "adgroup_id bigint, pid string, clk int, d string").withColumn(
        "d", F.to_date("d")).withColumns({"cate_id": F.lit(1), "campaign_id": F.lit(2),
                                          "customer": F.lit(3), "p0": F.lit(0.1)})


def test_few_missing_of_very_many_are_not_none(spark):
    profile = spark.createDataFrame([("a", 100 * 4000 / 10**12, 4000, 0.1),
                                     ("b", 100 * (0.01 + 1e-10), 10, 3.0 + 1e-8)],
                                    "column_name string, pct_null double, n_null bigint, z double")
    got = {r["column_name"]: r["decision"] for r in quality.imputation_decision(profile).collect()}
    assert got == {"a": fv.DROP_ROWS, "b": fv.KEEP_UNKNOWN}


def test_small_spread_on_a_large_value_is_a_leak(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3 == 0).cast("int").alias("y"), F.lit(7.5).alias("flat")).withColumn(
        "x", F.lit(1.7e9) + F.col("y"))
    got = df.agg(correlation(F.col("x"), F.col("y")).alias("r"),
                 correlation(F.col("flat"), F.col("y")).alias("none")).first()
    assert got["r"] == pytest.approx(1.0) and got["none"] is None


def test_a_feature_without_spread_has_its_own_verdict(spark):
    gold = spark.range(100).select(F.to_date(F.lit("2024-01-09")).alias("d"),
                                   (F.col("id") % 2).cast("int").alias("clk"),
                                   *[F.lit(1.0).alias(n) for n in CONFIG.measured_numeric])
    checks = leakage.feature_correlations(gold, CONFIG)
    assert {r["verdict"] for r in checks.collect()} == {fv.NO_SPREAD}
    quality.require_all_ok(checks, "leakage")


def test_gates_fail_on_no_rows(spark):
    gold = spark.range(0).select(F.to_date(F.lit("2024-01-02")).alias("d"),
                                 *[F.lit(0.1).alias(f"ctr_hist_{e}") for e in CONFIG.entities])
    for check in (leakage.burn_in_nulls, leakage.rate_ranges):
        assert {r["verdict"] for r in check(gold, CONFIG).collect()} == {fv.NO_ROWS}
        with pytest.raises(DataQualityError):
            quality.require_all_ok(check(gold, CONFIG), "leakage")


def test_undated_rows_change_no_feature(spark):
    dated = [(i, i % 3, 1_704_200_000 + 40_000 * i, i % 4, "slot_0", i % 2, f"2024-01-{2 + i // 3:02d}")
             for i in range(18)]
    undated = [(100 + i, i % 3, None, 1, "slot_0", 1, None) for i in range(6)]

    def features(rows, lag, hot):
        df = _rows(spark, rows)
        config = Config(splits=CONFIG.splits, hot_user_rows=hot)
        out = fatigue.with_user_fatigue(df, config, lag_days=lag)
        out = history.with_slot_rate(out, config=config)
        out = history.with_entity_history(out.drop("p0"), config)
        return {r["event_id"]: r for r in out.collect()}

    for lag, hot in ((0, 1000), (1, 1000), (0, 2)):
        plain, mixed = features(dated, lag, hot), features(dated + undated, lag, hot)
        assert all(plain[i] == mixed[i] for i in plain)
        for i in range(100, 106):
            assert mixed[i]["order_seen"] is None and mixed[i]["clk_prev"] is None
            assert mixed[i]["ctr_hist_cate_id"] is None
    counts = ingest.undated_rows(("t", _rows(spark, dated + undated))).first()
    assert (counts["rows"], counts["undated"]) == (24, 6)


def test_a_flipped_label_moves_no_tied_row(spark):
    rows = [(5, 1_704_200_000, 7, "slot_0", c, 1 - c) for c in (1, 0, 1)] + [
        (5, 1_704_200_000, 8, "slot_0", 0, 1), (5, 1_704_300_000, 7, "slot_0", 0, 1)]
    names = "userid bigint, time_stamp bigint, adgroup_id bigint, pid string, clk int, nonclk int"

    def seen(data):
        df = ingest.with_row_id(spark.createDataFrame(data, names))
        out = fatigue.with_user_order(df)
        return sorted((r["time_stamp"], r["adgroup_id"], r["clk_prev"]) for r in out.collect()), {
            r["event_id"] for r in out.collect()}

    flipped = [rows[0][:4] + (0, 1)] + rows[1:]
    (before, ids), (after, ids_after) = seen(rows), seen(flipped)
    assert ids == ids_after
    assert before[:3] == after[:3] == [(1_704_200_000, 7, 0)] * 3
    assert before[3:] == [(1_704_200_000, 8, 2), (1_704_300_000, 7, 2)]


def test_row_ids_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, 5), (5, None)], "userid bigint, adgroup_id bigint")
    assert ingest.with_row_id(df).select("event_id").distinct().count() == 2


def test_lagged_rates_keep_the_missing_user(spark):
    rows = [(i, None, 1_704_200_000 + 86_400 * i, 1, "slot_0", 1, f"2024-01-{2 + i:02d}")
            for i in range(4)]
    got = fatigue.with_user_fatigue(_rows(spark, rows), CONFIG, lag_days=1).collect()
    rates = [r["ctr_user_prev"] for r in sorted(got, key=lambda r: r["event_id"])]
    m = CONFIG.user_prior_weight
    assert rates == pytest.approx([(k + m * 0.1) / (k + m) for k in range(4)])


def test_ids_below_32_bits_do_not_fit(spark):
    matrix = spark.createDataFrame([(-3_000_000_000, 1, 1.0)], "userid bigint, cate_id bigint, clicks double")
    got = {r["id"]: r["fits"] for r in recommend.id_ranges(matrix).collect()}
    assert got == {"userid": False, "cate_id": True}


def test_files_with_swapped_columns_stop_the_read(spark, tmp_path):
    names = list(contract.ADS.types)
    (tmp_path / "a.csv").write_text(",".join(names) + "\n1,2,3,4,5.0,6.0\n")
    assert contract.read_csv(spark, contract.ADS, str(tmp_path)).typed.count() == 1
    swapped = [names[1], names[0], *names[2:]]
    (tmp_path / "b.csv").write_text(",".join(swapped) + "\n2,1,3,4,5.0,6.0\n")
    with pytest.raises(Exception, match="header"):
        contract.read_csv(spark, contract.ADS, str(tmp_path)).typed.collect()


def test_only_finished_layers_of_the_same_configuration_are_reused(spark, tmp_path):
    path, built = str(tmp_path / "layer"), []

    def build():
        built.append(1)
        return spark.range(3)

    for stamp in ("a", "a", "b"):
        assert layers.build_layer(spark, path, ["id"], build, stamp=stamp).count() == 3
    assert len(built) == 2
    (tmp_path / "layer" / "_SUCCESS").unlink()
    layers.build_layer(spark, path, ["id"], build, stamp="b")
    assert len(built) == 3


def test_slices_follow_the_scores(spark):
    """All scores below 1e-4: no slice holds more than an eighth of them (and some slack)."""
    pred = spark.range(200_000).select(
        ((F.xxhash64("id") % 1_000_000 + 1_000_000) / 2e10).alias("p_calibrated"),
        (F.col("id") % 50 == 0).cast("int").alias("clk"))
    table = metrics.score_table(pred)
    sizes = [r["count"] for r in table.groupBy("slice").count().collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) == parts and max(sizes) < 1.3 * sum(sizes) / parts
    assert metrics.score_table(table) is table
    assert metrics.binary_metrics(table).first() == metrics.binary_metrics(pred).first()


def test_id_index_is_dense_beyond_32_bits(spark):
    ids = spark.range(5000).select((F.col("id") * 7_000_000_001 - 10**13).alias("u"))
    got = recommend.id_index(ids.unionByName(ids), "u").orderBy("id").collect()
    assert [r["index"] for r in got] == list(range(5000))
    assert [r["id"] for r in got] == sorted(r["u"] for r in ids.collect())


def test_several_profiles_are_counted_without_pairs(spark):
    imp = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11), (None, 11), (3, 99)],
                                "userid bigint, adgroup_id bigint")
    ads = spark.createDataFrame([(10,), (11,), (11,)], "adgroup_id bigint")
    users = spark.createDataFrame([(1,), (1,), (1,), (2,)], "userid bigint")
    rows = {r["check"]: r["rows"] for r in quality.join_cardinality(imp, ads, users).collect()}
    joined = imp.join(ads, "adgroup_id")
    assert rows["inner_ads"] == joined.count() == 7
    assert rows["inner_ads_left_profiles"] == joined.join(users, "userid", "left").count()


def _exists(spark, path):
    found, fs = layers._hadoop_path(spark, path)
    return fs.exists(found)


def test_staged_tables_live_as_long_as_their_scope(spark):
    df = spark.range(100)
    with layers.scope(spark) as outer:
        with layers.scope(spark) as inner:
            gone, kept, early = (layers.staged(df.groupBy((F.col("id") % k).alias("k")).count(), "t")
                                 for k in (3, 5, 7))
            inner.keep(kept)
            assert _exists(spark, early._staged_at)
            inner.drop(early)
            assert not _exists(spark, early._staged_at)
        assert not _exists(spark, gone._staged_at) and _exists(spark, kept._staged_at)
        assert kept.count() == 5 and outer.paths == [kept._staged_at]
    assert not _exists(spark, kept._staged_at)
    free = layers.staged(df, "t")
    assert _exists(spark, free._staged_at)


def test_a_failed_scope_leaves_a_list(spark):
    with pytest.raises(ZeroDivisionError):
        with layers.scope(spark):
            left = layers.staged(spark.range(3), "t")
            1 / 0
    listed = spark.read.parquet(f"{layers.shared_folder(spark)}/lagwise/left-over")
    assert left._staged_at in [r["path"] for r in listed.collect()]
    assert left.count() == 3 and not layers._scopes()


def test_staging_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(layers._CLEANUP, None)
    assert layers.staged(spark.range(10).repartition(3), "t").count() == 10
    assert spark.conf.get(layers._CLEANUP, None) == before
