"""Every operator as a query over the test tables: ``(spark, sf_dir) -> DataFrame``."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwise import fixed_values as fv
from lagwise.functions.columns import corrected_probability
from lagwise.ml import features as feat
from lagwise.ml import models
from lagwise.ml.transformers import PriorCorrector, TokenEncoder
from lagwise.operators import (enrich, fatigue, history, ingest, leakage, metrics, products, quality,
                               quantiles, ranking, recommend, sampling, split)
from lagwise.operators.gold import gold_columns, gold_features
from lagwise.operators.ingest import with_time_features
from lagwise.plans import standins
from lagwise.plans.standins import STANDIN_CONFIG as CONFIG
from lagwise.sources import contract, layers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_LAYER_PATHS: dict[tuple[str, str, str], str] = {}

SCORE = "p_calibrated"
FRACTIONS = (0.1, 0.25, 0.5, 1.0)
# Decisions that exercise all four actions; the measured ones are in imputation_decision.
MIXED_DECISIONS = {
    "cms_segid": fv.NO_ACTION, "cms_group_id": fv.KEEP_UNKNOWN,
    "final_gender_code": fv.KEEP_UNKNOWN, "age_level": fv.IMPUTE_MODE,
    "pvalue_level": fv.KEEP_UNKNOWN, "shopping_level": fv.KEEP_UNKNOWN,
    "occupation": fv.IMPUTE_MODE, "new_user_class_level": fv.DROP_ROWS,
}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- inputs -----------------------------------------------------------------------------------------

def _impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time_features(standins.impressions(spark, sf_dir), CONFIG)


def _layer(spark: SparkSession, sf_dir: str, name: str,
           build: Callable[[], DataFrame], required: Sequence[str],
           partition_by: str | None = CONFIG.columns.day) -> DataFrame:
    """A layer written once per application and data folder, then read by all who need it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LAYER_PATHS:
        path = layers.fresh_path(spark, name)
        layers.build_layer(spark, path, required, build, partition_by)
        _LAYER_PATHS[key] = path
    return spark.read.parquet(_LAYER_PATHS[key])


def build_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.silver_table(_impressions(spark, sf_dir), standins.ads(spark, sf_dir),
                               standins.profiles(spark, sf_dir), CONFIG)


def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "silver", lambda: build_silver(spark, sf_dir),
                  [*CONFIG.profile_columns, "no_profile", "brand_known", "price_valid"])


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "gold",
                  lambda: gold_features(silver_layer(spark, sf_dir), CONFIG),
                  gold_columns(CONFIG))


def volume_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines joined with their orders, once for all that follows."""
    return _layer(spark, sf_dir, "volume", lambda: standins.volume(spark, sf_dir),
                  standins.VOLUME_CONFIG.entities, partition_by=None)


def _splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return split.temporal_split(gold_layer(spark, sf_dir), CONFIG)


def _scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with a score that SQL can follow: the smoothed rate of the user."""
    *_, test = split.temporal_split(_with_fatigue(spark, sf_dir), CONFIG)
    return test.select("event_id", "clk", F.col("ctr_user_prev").alias(SCORE))


def _with_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    imp = standins.impressions(spark, sf_dir)
    prior = history.deferred_prior(history.daily_totals(imp, ["d"], CONFIG), CONFIG)
    return imp.join(F.broadcast(prior), "d", "left")  # one row per calendar day


def _with_fatigue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fatigue.with_user_fatigue(_with_prior(spark, sf_dir), CONFIG,
                                     history_of=standins.impressions(spark, sf_dir))


# --- contract, layers, time -------------------------------------------------------------------------

@query
def csv_contract_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles through a CSV with a dirty header (mark, trailing space, capitals, extra column)."""
    path = layers.fresh_path(spark, "profiles-csv")
    dirty = standins.all_profiles(spark, sf_dir).select(
        F.col("userid").alias("﻿UserID"), *CONFIG.profile_columns[:-1],
        F.col("new_user_class_level").alias("new_user_class_level "),
        F.lit("x").alias("not_declared"))
    (dirty.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path))
    return contract.read_csv(spark, contract.PROFILES, path).typed


@query
def schema_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.apply_contract(_as_text(standins.raw_ads(spark, sf_dir)), contract.ADS).typed


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query
def cast_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = standins.impressions(spark, sf_dir).withColumnRenamed("userid", "user")
    return contract.audit_cast(
        contract.apply_contract(_as_text(clicks), contract.IMPRESSIONS),
        contract.apply_contract(_as_text(standins.raw_ads(spark, sf_dir)), contract.ADS),
        contract.apply_contract(_as_text(standins.all_profiles(spark, sf_dir)), contract.PROFILES))


@query
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _impressions(spark, sf_dir).select(
        "event_id", "ts_utc_s", "ts_local", "d", "hour", "day_part", "dow", "weekend")


def _bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "bronze", lambda: _impressions(spark, sf_dir),
                  ["userid", "time_stamp", "adgroup_id", "pid", "clk", "ts_local", "d", "hour",
                   "day_part"])


@query
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze_layer(spark, sf_dir).select(
        "event_id", "userid", "time_stamp", "adgroup_id", "pid", "clk", "ts_local", "d", "hour",
        "day_part")


@query
def layer_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.layer_partitions(_bronze_layer(spark, sf_dir), "d")


@query
def layer_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.layer_footprint(_bronze_layer(spark, sf_dir))


# --- enrichment and quality -------------------------------------------------------------------------

@query
def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_ads(standins.impressions(spark, sf_dir), standins.ads(spark, sf_dir))
    return joined.select("event_id", "adgroup_id", "cate_id", "campaign_id", "customer", "brand",
                         "price")


@query
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enriched(
        standins.impressions(spark, sf_dir).withColumn("ts_utc_s", F.lit(None)),
        standins.ads(spark, sf_dir), standins.profiles(spark, sf_dir), CONFIG)


@query
def silver_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(spark, sf_dir)


@query
def sentinel_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_profiles(standins.impressions(spark, sf_dir),
                                  standins.profiles(spark, sf_dir), CONFIG)
    return enrich.fill_sentinel(joined, CONFIG.profile_columns).select(
        "event_id", *CONFIG.profile_columns)


@query
def join_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.join_cardinality(
        standins.impressions(spark, sf_dir), standins.ads(spark, sf_dir),
        standins.profiles(spark, sf_dir), CONFIG)


@query
def missingness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shown(_missingness(spark, sf_dir))


def _missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missingness_profile(standins.impressions(spark, sf_dir),
                                       standins.profiles(spark, sf_dir), CONFIG)


@query
def imputation_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shown(quality.imputation_decision(_missingness(spark, sf_dir), CONFIG))


@query
def imputation_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions that the table itself calls for, carried out on it."""
    decided = quality.decisions_by_column(
        quality.imputation_decision(_missingness(spark, sf_dir), CONFIG))
    joined = enrich.with_profiles(standins.impressions(spark, sf_dir),
                                  standins.profiles(spark, sf_dir), CONFIG)
    return quality.apply_imputation(joined, decided).select("event_id", *CONFIG.profile_columns)


@query
def undated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions as they came, and with the times of one user in thirteen lost."""
    imp = standins.impressions(spark, sf_dir).select("userid", "time_stamp")
    lost = imp.withColumn("time_stamp", F.when(F.col("userid") % 13 != 0, F.col("time_stamp")))
    return ingest.undated_rows(("impressions", imp), ("with_lost_times", lost), config=CONFIG)


@query
def imputation_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_profiles(standins.impressions(spark, sf_dir),
                                  standins.profiles(spark, sf_dir), CONFIG)
    return quality.apply_imputation(joined, MIXED_DECISIONS).select(
        "event_id", *CONFIG.profile_columns)


@query
def feature_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, *_ = _splits(spark, sf_dir)
    return quality.null_counts(train, [*CONFIG.categorical, *CONFIG.numeric])


# --- point-in-time features -------------------------------------------------------------------------

@query
def daily_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.daily_ctr(standins.impressions(spark, sf_dir), CONFIG)


@query
def deferred_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = history.daily_totals(standins.impressions(spark, sf_dir), ["d"], CONFIG)
    return _rounded(history.deferred_prior(daily, CONFIG), ["p0"])


@query
def deferred_entity_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_ads(standins.impressions(spark, sf_dir), standins.ads(spark, sf_dir))
    return history.deferred_entity_ctr(
        joined.select("event_id", "d", "clk", *CONFIG.entities), CONFIG)


@query
def entity_history_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity-day history of the largest table, for three high-cardinality entities."""
    config = standins.VOLUME_CONFIG
    lines = volume_layer(spark, sf_dir)
    rows, parts = lines.count(), []
    for e in config.entities:
        h = history.entity_history(history.daily_totals(lines, [e, "d"], config, rows), e, config)
        parts.append(h.select(F.lit(e).alias("entity"), F.col(e).alias("entity_id"), "d",
                              "imp_prev", "clk_prev"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def deferred_entity_ctr_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with the leak-free rate of its part, supplier and customer."""
    config = standins.VOLUME_CONFIG
    wide = history.with_entity_history(volume_layer(spark, sf_dir), config, combined=False)
    return _rounded(wide.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_custkey",
        *[f"ctr_hist_{e}" for e in config.entities]),
        [f"ctr_hist_{e}" for e in config.entities])


@query
def user_fatigue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_fatigue(spark, sf_dir).select(
        "event_id", "order_capped", "gap_sec", "gap_bucket", "ctr_user_prev", "log_imp_prev",
        "log_gap")
    return _rounded(rows, ["ctr_user_prev", "log_imp_prev", "log_gap"])


@query
def user_fatigue_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order of rows with most users treated as too large for one task."""
    config = replace(CONFIG, hot_user_rows=20)
    return fatigue.with_user_order(standins.impressions(spark, sf_dir), config).select(
        "event_id", "order_seen", "gap_sec", "clk_prev")


@query
def user_fatigue_lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user's rate from outcomes at least two days old."""
    rows = fatigue.with_user_fatigue(_with_prior(spark, sf_dir), CONFIG, lag_days=2)
    return _rounded(rows.select("event_id", "ctr_user_prev"), ["ctr_user_prev"])


@query
def slot_rolling_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    imp = standins.impressions(spark, sf_dir)
    rows = history.with_slot_rate(_with_prior(spark, sf_dir), history_of=imp, config=CONFIG)
    return _rounded(rows.select("event_id", "hour_idx", "ctr_6h"), ["ctr_6h"])


@query
def price_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_ads(standins.impressions(spark, sf_dir), standins.ads(spark, sf_dir))
    rows = history.with_price_relative(joined.select("event_id", "d", "cate_id", "price"), CONFIG)
    return _rounded(rows.select("event_id", "log_price", "price_rel"), ["log_price", "price_rel"])


@query
def gold_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_features(silver_layer(spark, sf_dir), CONFIG)
    return _rounded(gold, CONFIG.measured_numeric)


_QUERIES["gold_features"] = _QUERIES.pop("gold_features_query")


@query
def gold_append_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature layer of all days but the last, to which the last day is then added: the same rows
    as a build over all days."""
    day, silver = CONFIG.columns.day, silver_layer(spark, sf_dir)
    last = silver.agg(F.max(day)).first()[0]
    path = layers.fresh_path(spark, "gold-by-day")

    def upto(rows: DataFrame) -> DataFrame:
        return layers.build_layer(spark, path, gold_columns(CONFIG), lambda: gold_features(rows, CONFIG),
                                  day, grow=True)

    if last is not None:
        upto(silver.filter(F.col(day) < F.lit(last)))
    return _rounded(upto(silver), CONFIG.measured_numeric)


# --- split and leakage ------------------------------------------------------------------------------

@query
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = split.temporal_split(standins.impressions(spark, sf_dir), CONFIG)
    labelled = [p.select("event_id", "d", F.lit(name).alias("split")) for p, name in zip(
        parts, (fv.SPLIT_TRAIN, fv.SPLIT_VAL, fv.SPLIT_TEST))]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@query
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_summary(standins.impressions(spark, sf_dir), CONFIG)


@query
def leak_check_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.feature_correlations(gold_layer(spark, sf_dir), CONFIG)


@query
def leak_check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.burn_in_nulls(gold_layer(spark, sf_dir), CONFIG)


@query
def leak_check_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.rate_ranges(gold_layer(spark, sf_dir), CONFIG)


@query
def leak_check_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.recomputed_history(gold_layer(spark, sf_dir), CONFIG)


# --- sampling ---------------------------------------------------------------------------------------

@query
def negative_undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, *_ = split.temporal_split(standins.impressions(spark, sf_dir), CONFIG)
    return train.select("event_id", "clk", sampling.kept_in_sample(CONFIG).alias("kept"))


@query
def nested_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.nested_fractions(standins.impressions(spark, sf_dir), FRACTIONS, CONFIG)


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, *_ = split.temporal_split(standins.impressions(spark, sf_dir), CONFIG)
    return sampling.class_balance(train, CONFIG)


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, *_ = split.temporal_split(standins.impressions(spark, sf_dir), CONFIG)
    return _rounded(sampling.with_class_weights(train, CONFIG).select("event_id", "weight"),
                    ["weight"])


@query
def prior_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A probability inflated as undersampling would, and brought back."""
    rate = CONFIG.negative_rate
    inflated = _scored_test(spark, sf_dir).select(
        "event_id", corrected_probability(F.col(SCORE), 1 / rate).alias("p_sampled"))
    back = PriorCorrector(inputCol="p_sampled", outputCol="p_corrected", keptRate=rate)
    return _rounded(back.transform(inflated), ["p_sampled", "p_corrected"])


@query
def sampling_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_test(spark, sf_dir)
    return metrics.sampling_effect(
        scored, sampling.undersample_negatives(scored, CONFIG), SCORE, CONFIG)


# --- evaluation -------------------------------------------------------------------------------------

@query
def baseline_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = split.temporal_split(standins.impressions(spark, sf_dir), CONFIG)
    return metrics.binary_metrics(metrics.constant_prior(train, test, CONFIG), SCORE, CONFIG)


@query
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.binary_metrics(_scored_test(spark, sf_dir), SCORE, CONFIG)


@query
def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.auc(_scored_test(spark, sf_dir), SCORE, CONFIG),
                    ["auc_roc", "auc_pr"])


@query
def score_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.score_deciles(_scored_test(spark, sf_dir), SCORE, config=CONFIG)


QUANTILES = (0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


@query
def score_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of order quantities from a table of values and counts, which has heavy ties; the
    exact rank of each is within the error it was asked for."""
    table = standins.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_quantity").cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    found = quantiles.approximate_quantiles(table, list(QUANTILES), 0.01)
    return quantiles.rank_errors(table, found).select(
        "probability", (F.col("rank_error") <= 0.01).alias("within"))


@query
def score_quantiles_small_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of prices with an error under one row are order statistics."""
    table = standins.table(spark, sf_dir, "orders").groupBy(
        F.col("o_totalprice").cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return quantiles.approximate_quantiles(table, list(QUANTILES[1:]), 1e-9)


@query
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pr_curve(_scored_test(spark, sf_dir), SCORE, config=CONFIG)


# --- recommendation ---------------------------------------------------------------------------------

def _clicks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Click matrices of the training and the test days."""
    joined = enrich.with_ads(standins.impressions(spark, sf_dir), standins.ads(spark, sf_dir))
    train, _, test = split.temporal_split(joined, CONFIG)
    return (recommend.interaction_matrix(train, CONFIG),
            recommend.interaction_matrix(test, CONFIG))


@query
def interaction_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir)[0]


@query
def id_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.id_ranges(*_clicks(spark, sf_dir), config=CONFIG)


@query
def popularity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.popularity_topk(_clicks(spark, sf_dir)[0], config=CONFIG)


def _popular_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _clicks(spark, sf_dir)
    return recommend.popularity_lists(test, train, config=CONFIG)


@query
def popularity_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _popular_lists(spark, sf_dir).select(
        "userid", F.array_join(F.col("recommended").cast("array<string>"), ",")
        .alias("recommended"))


@query
def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ranking.list_rows(_popular_lists(spark, sf_dir), "userid", "recommended")
    truth = _clicks(spark, sf_dir)[1].select("userid", F.col("cate_id").alias("item"))
    return ranking.ranking_metrics(lists, truth, config=CONFIG)


@query
def popularity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared list judged on the test users, without a copy of it per user."""
    train, test = _clicks(spark, sf_dir)
    truth = test.select("userid", F.col("cate_id").alias("item"))
    return ranking.shared_list_metrics(recommend.popularity_topk(train, config=CONFIG), truth,
                                       config=CONFIG)


@query
def id_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers for the order keys of all order lines."""
    return recommend.id_index(standins.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def als_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = recommend.fit_als(_clicks(spark, sf_dir)[0], CONFIG)
    return recommend.als_rows(model, config=CONFIG)


@query
def als_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _clicks(spark, sf_dir)
    model = recommend.fit_als(train, CONFIG)
    lists = recommend.als_rows(model, config=CONFIG, users=test)
    truth = test.select("userid", F.col("cate_id").alias("item"))
    return ranking.ranking_metrics(lists, truth, config=CONFIG,
                                   users_with_list=model.userFactors.count())


@query
def als_blocks_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many users needed how many blocks of items."""
    found = recommend.als_search(recommend.fit_als(_clicks(spark, sf_dir)[0], CONFIG), config=CONFIG)
    return found.filter("rank = 1").groupBy("blocks").agg(F.count(F.lit(1)).alias("users"))


def _weighted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of very different norms: (id, features)."""
    size = 1 / (1 + F.col("vec_id") % 97)
    return standins.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.transform("embedding", lambda x: x.cast("double") * size).alias("features"))


@query
def product_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows with the largest inner product for every row."""
    rows = _weighted_vectors(spark, sf_dir)
    return _rounded(products.top_products(rows, rows, 10).drop("blocks"), ["score"])


# --- feature pipeline and models --------------------------------------------------------------------

@query
def token_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_profiles(standins.impressions(spark, sf_dir),
                                  standins.profiles(spark, sf_dir), CONFIG)
    inputs = list(CONFIG.profile_columns)
    encoded = TokenEncoder(inputCols=inputs).transform(joined)
    return encoded.select("event_id", *[f"{c}_cat" for c in inputs])


@query
def frequency_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.with_profiles(standins.impressions(spark, sf_dir),
                                  standins.profiles(spark, sf_dir), CONFIG)
    return feat.frequency_index(joined, "new_user_class_level")


@query
def feature_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.feature_registry(gold_layer(spark, sf_dir), CONFIG)


@query
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    train, _, test = _splits(spark, sf_dir)
    prepared = feat.feature_pipeline(None, CONFIG, scale=True).fit(train).transform(test)
    values = vector_to_array(feat.FEATURES)
    return prepared.select("event_id", F.size(values).alias("slots"),
                           F.size(F.filter(values, lambda v: v != 0)).alias("non_zeros"))


def _fitted(spark: SparkSession, sf_dir: str, name: str):
    train, _, test = _splits(spark, sf_dir)
    model, rate = models.undersampled_fit(train, models.experiments(CONFIG)[name], CONFIG)
    return model, rate, test


def _test_scores(model, test: DataFrame, rate: float) -> DataFrame:
    return models.scored(model, test, rate).select("event_id", SCORE)


@query
def lr_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rate, test = _fitted(spark, sf_dir, "lr_full")
    return _test_scores(model, test, rate)


@query
def lr_context_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rate, test = _fitted(spark, sf_dir, "lr_context")
    return _test_scores(model, test, rate)


@query
def rf_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rate, test = _fitted(spark, sf_dir, "rf_full")
    return _test_scores(model, test, rate)


@query
def gbt_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rate, test = _fitted(spark, sf_dir, "gbt_full")
    return _test_scores(model, test, rate)


@query
def lr_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = _splits(spark, sf_dir)
    model, factor = models.weighted_fit(train, models.experiments(CONFIG)["lr_full"], CONFIG)
    return models.scored(model, test, odds_factor=factor).select("event_id", SCORE)


def _tuned(spark: SparkSession, sf_dir: str):
    train, val, _ = _splits(spark, sf_dir)
    experiment = models.experiments(CONFIG)["lr_context"]
    tuned = models.tune(sampling.undersample_negatives(train, CONFIG), experiment,
                        CONFIG, search_fraction=1.0)
    return tuned, experiment, train, val


@query
def cv_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    tuned, experiment, train, _ = _tuned(spark, sf_dir)
    return models.grid_table(tuned, experiment, train)


@query
def optimism_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    tuned, _, train, val = _tuned(spark, sf_dir)
    return models.optimism_gap(tuned, val, sampling.effective_rate(train, CONFIG), CONFIG)


@query
def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val, _ = _splits(spark, sf_dir)
    return models.learning_curve(
        sampling.undersample_negatives(train, CONFIG), val,
        models.experiments(CONFIG)["lr_full"], sampling.effective_rate(train, CONFIG),
        config=CONFIG)


@query
def feature_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, test = _fitted(spark, sf_dir, "lr_full")
    return feat.feature_weights(model, test, top=None)
