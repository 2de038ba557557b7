"""Transformers, feature names, and the whole run from CSV files."""
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.ml import features as feat
from lagwise.ml import models
from lagwise.ml.transformers import PriorCorrector, TokenEncoder
from lagwise.operators import sampling, split
from lagwise.plans import queries as q
from lagwise.plans import run, standins

CONFIG = standins.STANDIN_CONFIG


def test_transformers_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 0.4), (None, "b", 0.2)], "a int, b string, p double")
    for i, stage in enumerate((
            TokenEncoder(inputCols=["a", "b"], outputCols=["ta", "tb"], token="?"),
            PriorCorrector(inputCol="p", outputCol="q", keptRate=0.25))):
        path = str(tmp_path / str(i))
        stage.save(path)
        again = type(stage).load(path)
        assert again.transform(df).collect() == stage.transform(df).collect()
    tokens = TokenEncoder(inputCols=["a", "b"]).transform(df).collect()
    assert [(r["a_cat"], r["b_cat"]) for r in tokens] == [("1", "DESCONOCIDO"),
                                                         ("DESCONOCIDO", "b")]


@pytest.mark.parametrize("rate", [0.0, 1.5])
def test_corrector_refuses_an_impossible_rate(spark, rate):
    df = spark.createDataFrame([(0.5,)], "probability double")
    with pytest.raises(ValueError):
        PriorCorrector(keptRate=rate).transform(df)


def test_feature_names_line_up_with_the_vector(spark):
    rows = [(f"c{i % 8}", f"d{i % 2}", float(i), i % 3 == 0) for i in range(64)]
    df = spark.createDataFrame(rows, "c string, d string, x double, y boolean").withColumn(
        "clk", F.col("y").cast("int")).withColumn(
        "c", F.when(F.col("x") == 5, None).otherwise(F.col("c")))
    stages = feat.feature_stages(["c", "d"], ["x"], scale=True)
    model = Pipeline(stages=stages + [LogisticRegression(labelCol="clk", maxIter=3)]).fit(df)
    names = feat.feature_names(model, df)
    assert len(names) == len(model.stages[-1].coefficients) == 10 + 3 + 1
    assert names[-1] == "x" and all(n.startswith("c_ohe") for n in names[:10])
    table = feat.feature_weights(model, df, top=None).collect()
    by_name = {r["feature"]: r["weight"] for r in table}
    assert by_name["x"] == pytest.approx(float(model.stages[-1].coefficients[-1]))
    sizes = [r["magnitude"] for r in table]
    assert sizes == sorted(sizes, reverse=True)


def test_frequency_index_equals_string_indexer(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    df = standins.impressions(spark, sf_dir).withColumn("k", F.col("adgroup_id").cast("string"))
    ours = {r["label"]: r["label_index"] for r in feat.frequency_index(df, "k").collect()}
    labels = StringIndexer(inputCol="k", outputCol="i").fit(df).labels
    assert ours == {label: i for i, label in enumerate(labels)}


def test_context_experiment_has_no_history():
    numeric = models.experiments()["lr_context"].numeric
    assert not [c for c in numeric if c.startswith(("ctr_", "log_imp"))]
    assert len(Config().numeric) == 19 and len(Config().categorical) == 12
    assert {n: len(e.grid) for n, e in models.experiments().items()} == {
        "lr_context": 2, "lr_full": 6, "rf_full": 2, "gbt_full": 2}


def test_weighted_fit_is_recalibrated(spark, sf_dir):
    train, _, test = split.temporal_split(q.gold_layer(spark, sf_dir), CONFIG)
    for rows in (train, train.withColumn("clk", 1 - F.col("clk"))):  # then positives are the majority
        model, factor = models.weighted_fit(rows, models.experiments(CONFIG)["lr_context"], CONFIG)
        assert factor == pytest.approx(1 / sampling.positive_weight(rows).first()["weight"])
        mean = models.scored(model, rows, odds_factor=factor).agg(F.avg("p_calibrated")).first()[0]
        real = rows.agg(F.avg("clk")).first()[0]
        assert 0.9 < mean / real < 1.1
    assert factor > 1


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    """Three CSV files made from the test tables, dated like the published days."""
    folder = tmp_path_factory.mktemp("csv")
    sf_dir = "/root/testdata/sf0.01"
    # 31 days squeezed into 8: the order of rows is kept.
    start = 1_704_067_200
    imp = standins.impressions(spark, sf_dir).select(
        F.col("userid").alias("user"),
        (F.lit(1_494_000_000) + F.floor((F.col("time_stamp") - start) * 8 / 30)
         .cast("bigint")).alias("time_stamp"), "adgroup_id", "pid", "nonclk", "clk")
    ads = standins.raw_ads(spark, sf_dir)
    profiles = standins.profiles(spark, sf_dir).withColumnRenamed(
        "new_user_class_level", "new_user_class_level ")
    for name, df in (("raw_sample", imp), ("ad_feature", ads), ("user_profile", profiles)):
        df.write.option("header", True).option("ignoreTrailingWhiteSpace", False) \
            .csv(str(folder / f"{name}.csv"))
    return str(folder)


def test_whole_run(spark, csv_folder, tmp_path):
    out, config = str(tmp_path), Config(negative_rate=0.5)
    bronze = run.build_bronze(spark, csv_folder, out, config)
    silver = run.build_silver(spark, bronze, out, config)
    gold = run.build_gold(spark, silver, out, config)
    n = bronze.impressions.count()
    assert n == 10_000 == silver.count() == gold.count()
    assert "brand" not in silver.columns and "nonclk" not in silver.columns
    assert spark.table("gold").count() == n
    train, val, test = split.temporal_split(gold, config)
    assert train.select("d").distinct().count() == 5 and val.count() > 0 and test.count() > 0
    assert "franja" in run.published(gold).columns
    reports = run.run_experiments(gold, config, only=["lr_context"], quick=True)
    rows = reports["metrics"].collect()
    assert {(r["experiment"], r["days"]) for r in rows} == {
        (name, days) for name in ("baseline_prior", "lr_context") for days in ("val", "test")}
    assert all(r["d1_lift"] > 0 for r in rows)
    assert run.best_experiment(reports["metrics"]) == "lr_context"
    record = reports["fits"].first()
    assert record["fits"] == 3 and record["refit_seconds"] > 0 and record["params"]
    judged = {r["experiment"]: r for r in rows if r["days"] == "test"}
    assert judged["baseline_prior"]["auc_pr"] == judged["baseline_prior"]["observed"]
    assert 0.3 < judged["lr_context"]["calibration_bias"] < 3.0
    assert reports["deciles"].count() > 1 and reports["weights"].count() == 25
    effect = {r["metric"]: r for r in reports["sampling_effect"].collect()}
    assert effect["auc_pr"]["sampled"] > effect["auc_pr"]["full"]
    ranked = {r["experiment"]: r for r in run.run_recommendation(gold, config, quick=True)
              .collect()}
    assert ranked["popularity"]["coverage_pct"] == 100.0
    assert ranked["als"]["users_evaluated"] > 0
    again = run.build_bronze(spark, csv_folder, out, config)
    assert again.impressions.count() == n


def test_main_with_every_flag(spark, csv_folder, tmp_path):
    out = str(tmp_path)
    run.main(["--csv", csv_folder, "--out", out, "--quick", "--only", "lr_context", "--weighted",
              "--learning-curve", "--fraction", "0.9"])
    reports = f"{out}/fraction-0.9/reports"
    weighted = spark.read.parquet(f"{reports}/weighted")
    assert {r["experiment"] for r in weighted.collect()} == {"lr_weighted", "lr_undersampled"}
    assert spark.read.parquet(f"{reports}/learning_curve").count() == 2
    assert spark.read.parquet(f"{reports}/ranking").count() == 2
