"""Precision, recall, MAP and NDCG at k of recommendation lists."""
from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.config import Config
from lagwise.functions.columns import ratio


def list_rows(lists: DataFrame, user: str, column: str, item: str = "item") -> DataFrame:
    """(user, list) as (user, rank, item), ranks from 1."""
    return lists.select(user, F.posexplode(column).alias("rank", item)).withColumn(
        "rank", F.col("rank") + 1)


def _judged(hits: DataFrame, wanted: DataFrame, evaluated: Column, with_list: Column, k: int,
            config: Config) -> DataFrame:
    """The metrics from the hits (user, rank) alone; users without a hit add nothing to a sum."""
    user = config.columns.user
    nth = F.row_number().over(Window.partitionBy(user).orderBy("rank"))
    per_user = hits.select(user, "rank", nth.alias("nth")).groupBy(user).agg(
        F.count(F.lit(1)).alias("found"),
        F.sum(F.col("nth") / F.col("rank").cast("double")).alias("precision_sum"),
        F.sum(1 / F.log2(F.col("rank") + F.lit(1.0))).alias("dcg"))
    wanted_per_user = wanted.groupBy(user).agg(F.count(F.lit(1)).alias("wanted"))
    ideal = list(accumulate(1 / math.log2(rank + 1) for rank in range(1, k + 1)))
    reachable = F.least("wanted", F.lit(k))
    best = F.element_at(F.array(*map(F.lit, ideal)), reachable.cast("int"))
    sums = per_user.join(wanted_per_user, user).agg(
        F.sum(F.col("found") / F.lit(float(k))).alias("p"),
        F.sum(ratio(F.col("found"), F.col("wanted"))).alias("r"),
        F.sum(ratio(F.col("precision_sum"), reachable)).alias("map"),
        F.sum(F.col("dcg") / best).alias("ndcg"))
    with_truth = wanted_per_user.agg(F.count(F.lit(1))).scalar()
    full = sums.withColumns({"users_evaluated": evaluated, "users_with_truth": with_truth,
                             "users_with_list": with_list})

    def metric(name: str, out: str):
        return F.round(F.coalesce(ratio(F.col(name), F.col("users_evaluated")), F.lit(0.0)),
                       6).alias(out)

    return full.select(
        F.lit(k).alias("k"), "users_evaluated", "users_with_truth", "users_with_list",
        F.round(F.coalesce(100 * ratio(F.col("users_evaluated"), F.col("users_with_truth")),
                           F.lit(0.0)), 6).alias("coverage_pct"),
        metric("p", "precision_at_k"), metric("r", "recall_at_k"),
        metric("map", "map_at_k"), metric("ndcg", "ndcg_at_k"))


def ranking_metrics(recommended: DataFrame, truth: DataFrame, k: int | None = None,
                    item: str = "item", config: Config = Config(),
                    users_with_list: int | None = None) -> DataFrame:
    """One row of metrics over the users that have both a recommendation and a truth.

    ``recommended`` holds (user, rank, item), ``truth`` holds (user, item). Everything stays in
    rows: no truth set is collected, so a user with a huge history is just many rows, and only
    the hits among their first ``k`` recommendations are ever ordered together.
    ``users_with_list`` is stated where ``recommended`` holds only the users that are judged.
    """
    user = config.columns.user
    k = config.top_k if k is None else k
    wanted = truth.select(user, item).distinct()
    top = recommended.filter(F.col("rank") <= k).select(user, "rank", item)
    listed = recommended.select(user).distinct()
    evaluated = wanted.select(user).distinct().join(listed, user).agg(F.count(F.lit(1))).scalar()
    with_list = F.lit(users_with_list).cast("bigint") if users_with_list is not None else \
        listed.agg(F.count(F.lit(1))).scalar()
    return _judged(top.join(wanted, [user, item]), wanted, evaluated, with_list, k, config)


def shared_list_metrics(top: DataFrame, truth: DataFrame, k: int | None = None,
                        item: str = "item", config: Config = Config()) -> DataFrame:
    """The same metrics where every user gets the list ``top`` (rank, item), of k rows.

    The list meets the truth, not the users: nobody gets a copy of it.
    """
    user = config.columns.user
    k = config.top_k if k is None else k
    wanted = truth.select(user, item).distinct()
    few = F.broadcast(top.filter(F.col("rank") <= k).select("rank", item))  # k rows
    users = wanted.select(user).distinct().agg(F.count(F.lit(1))).scalar()
    return _judged(wanted.join(few, item), wanted, users, users, k, config)
