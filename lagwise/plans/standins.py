"""The impression, ad and profile tables as views of the TPC-H-like test tables."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagwise.config import Columns, Config, Splits
from lagwise.functions.columns import epoch_seconds, flag, shift_hours

STANDIN_CONFIG = Config(splits=Splits(
    burn_in=date(2024, 1, 1),
    train_start=date(2024, 1, 2), train_end=date(2024, 1, 24),
    val_start=date(2024, 1, 25), val_end=date(2024, 1, 27),
    test_start=date(2024, 1, 28), test_end=date(2024, 1, 31)))

VOLUME_CONFIG = Config(
    columns=Columns(user="o_custkey", ad="l_partkey", row_id="line_id"),
    entities=("l_partkey", "l_suppkey", "o_custkey"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed impressions, as the contract reader would give them, plus row id and local day."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    clk = flag(F.col("event_type") == "click")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("userid"),
        epoch_seconds(F.col("ts")).alias("time_stamp"),
        F.to_date(shift_hours(F.col("ts"), STANDIN_CONFIG.utc_offset_hours)).alias("d"),
        k.alias("adgroup_id"),
        F.concat(F.lit("slot_"), (k % 2).cast("string")).alias("pid"),
        clk.alias("clk"), (1 - clk).alias("nonclk"))


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS adgroup_id", "CAST(p_size AS BIGINT) AS cate_id",
        "CAST(floor(p_partkey / 5) AS BIGINT) AS campaign_id",
        "CAST(substr(p_brand, 7) AS BIGINT) AS customer",
        "CASE WHEN p_partkey % 33 = 0 THEN 'NULL' ELSE substr(p_brand, 7) END AS brand",
        "CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS price")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_ads(spark, sf_dir).withColumn("brand", F.col("brand").try_cast("double"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as the features meet them: one user in seventeen has none."""
    return all_profiles(spark, sf_dir).where("userid % 17 <> 0")


def all_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS userid", "c_nationkey AS cms_segid",
        "1 + c_nationkey % 13 AS cms_group_id",
        "CAST(1 + c_custkey % 2 AS INT) AS final_gender_code",
        "c_nationkey % 7 AS age_level",
        "CASE WHEN c_custkey % 2 = 0 THEN NULL "
        "ELSE CAST(1 + c_custkey % 3 AS DOUBLE) END AS pvalue_level",
        "CAST(1 + c_custkey % 3 AS INT) AS shopping_level",
        "CAST(c_custkey % 2 AS INT) AS occupation",
        "CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN NULL "
        "ELSE CAST(1 + c_nationkey % 4 AS DOUBLE) END AS new_user_class_level")


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as impressions: the largest table, with three high-cardinality entities."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        flag(F.col("l_returnflag") == "R").alias("clk"), F.to_date("l_shipdate").alias("d"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey")
