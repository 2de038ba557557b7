"""User-item clicks, popularity and implicit-feedback factorisation."""
from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.errors import DataQualityError
from lagwise.operators.products import top_products
from lagwise.sources.layers import staged

INT_MAX = 2_147_483_647


def interaction_matrix(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Clicks per user and item (category); an impression without a click is no signal."""
    c = config.columns
    return (df.filter(F.col(c.label) == 1).groupBy(c.user, c.category)
            .agg(F.count(F.lit(1)).cast("double").alias("clicks")))


def id_ranges(*matrices: DataFrame, config: Config = Config()) -> DataFrame:
    """Largest user and item id over all matrices, and whether 32-bit factor ids hold them all."""
    c = config.columns
    ids = reduce(DataFrame.unionByName, [m.select(c.user, c.category) for m in matrices])
    top = ids.agg(F.coalesce(F.max(c.user), F.lit(0)).alias("u"),
                  F.coalesce(F.max(c.category), F.lit(0)).alias("i"),
                  F.coalesce(F.min(c.user), F.lit(0)).alias("u_low"),
                  F.coalesce(F.min(c.category), F.lit(0)).alias("i_low"))
    return top.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("id"), F.col(v).cast("bigint").alias("largest"),
                 ((F.col(v) <= INT_MAX) & (F.col(f"{v}_low") >= -INT_MAX - 1)).alias("fits"))
        for name, v in ((c.user, "u"), (c.category, "i"))])))


def require_int_ids(*matrices: DataFrame, config: Config = Config()) -> None:
    too_big = [r["id"] for r in id_ranges(*matrices, config=config).filter("not fits").collect()]
    if too_big:
        raise DataQualityError(f"ids beyond 32 bits, index them first: {too_big}")


def id_index(df: DataFrame, column: str) -> DataFrame:
    """(id, index): dense numbers from 0 in order of id, for ids that do not fit 32 bits.

    Distinct ids are dealt by ranges and numbered inside each; a range starts where those before
    it end, which one row per range tells. Written before that, so all parts see the same ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("id")).distinct()
    dealt = staged(ids.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()), "ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1
    return dealt.withColumn("inside", inside).join(F.broadcast(starts), "part").select(
        "id", (F.col("start") + F.col("inside")).alias("index"))


def popularity_topk(matrix: DataFrame, k: int | None = None,
                    config: Config = Config()) -> DataFrame:
    """The k most clicked items: (rank, item, clicks); the smaller id wins a tie."""
    item = config.columns.category
    k = config.top_k if k is None else k
    top = (matrix.groupBy(item).agg(F.sum("clicks").alias("clicks"))
           .orderBy(F.col("clicks").desc(), F.col(item)).limit(k))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("clicks")).alias("c"),
                                                   F.col(item).alias("i"))))  # k rows
    return top.agg(ordered.alias("items")).select(F.posexplode("items").alias("p", "x")).select(
        (F.col("p") + 1).alias("rank"), F.col("x.i").alias("item"),
        (-F.col("x.c")).alias("clicks"))


def popularity_lists(users: DataFrame, matrix: DataFrame, k: int | None = None,
                     config: Config = Config()) -> DataFrame:
    """The same top-k list for every user: (user, recommended)."""
    top = popularity_topk(matrix, k, config)
    items = top.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item"))),
                                lambda x: x["item"])).scalar()
    return users.select(config.columns.user).distinct().withColumn("recommended", items)


def fit_als(matrix: DataFrame, config: Config = Config(), iterations: int | None = None
            ) -> ALSModel:
    """Non-negative implicit ALS on the click matrix, after the id-range gate.

    Factors start from draws per block; the number of blocks is set and not counted.
    """
    c = config.columns
    require_int_ids(matrix, config=config)
    als = ALS(numUserBlocks=config.als_blocks, numItemBlocks=config.als_blocks,
              userCol=c.user, itemCol=c.category, ratingCol="clicks", implicitPrefs=True,
              nonnegative=True, coldStartStrategy="drop", rank=config.als_rank,
              regParam=config.als_reg, alpha=config.als_alpha, seed=config.seed,
              maxIter=config.als_iterations if iterations is None else iterations)
    return als.fit(matrix.select(F.col(c.user).cast("int"), F.col(c.category).cast("int"),
                                 "clicks"))


def als_rows(model: ALSModel, k: int | None = None, config: Config = Config(),
             users: DataFrame | None = None) -> DataFrame:
    """Top-k recommendations per user as (user, rank, item, score); the smaller item wins a tie.

    Only users in ``users`` get lists if it is given. Items are searched in falling order of norm, as
    far as each user needs.
    """
    return als_search(model, k, config, users).drop("blocks")


def als_search(model: ALSModel, k: int | None = None, config: Config = Config(),
               users: DataFrame | None = None) -> DataFrame:
    """:func:`als_rows` with the number of item blocks that were scored for each user."""
    c = config.columns
    k = config.top_k if k is None else k
    wanted = model.userFactors
    if users is not None:
        wanted = wanted.join(users.select(F.col(c.user).cast("int").alias("id")).distinct(), "id", "left_semi")
    found = top_products(wanted, model.itemFactors, k)
    return found.select(F.col("id").alias(c.user), "rank", "item", F.col("score").cast("float").alias("score"),
                        "blocks")
