"""Exact best items by inner product, without scoring all items for all users.

|user . item| <= |user| |item|. Items are taken in blocks of falling norm; a user whose k-th score
already exceeds its own norm times the largest norm left is done. A round sends the next
``ITEMS`` items, a fixed number, to all tasks and goes through the users that are still open.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.operators import ranges
from lagwise.sources.layers import staged

#: Items of a round (16 MB at 32 factors), of a block inside it, and users that are scored together.
ITEMS, BLOCK, USERS = 1 << 16, 512, 1024
#: What rounding may add to a product, as a share of the norms.
_SLACK = 1e-9


def _square(vector: str) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def _rows_of(lists: pa.Array, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), width)


class _Round:
    """The items of a round in blocks of falling norm, by id inside a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, next_norm: float):
        order = np.lexsort((ids, -norms))
        self.blocks = []
        for at in range(0, len(order), BLOCK):
            some = order[at:at + BLOCK]
            top = float(norms[some[0]])
            some = some[np.argsort(ids[some])]
            self.blocks.append((top, ids[some], vectors[some]))
        self.next_norm = next_norm

    def search(self, users: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, blocks scored, whether to go on) from the best so far (-inf: none yet)."""
        norms = np.sqrt(np.einsum("ij,ij->i", users, users))
        scored = np.zeros(len(users), dtype=np.int64)

        def open_(rows: np.ndarray, norm: float) -> np.ndarray:
            # Equality goes on: an item of the same score and a smaller id comes first.
            return rows[norms[rows] * norm * (1 + _SLACK) >= scores[rows, k - 1]]

        rows = np.arange(len(users))
        for norm, block_ids, vectors in self.blocks:
            rows = open_(rows, norm)
            if not len(rows):
                break
            scored[rows] += 1
            found = users[rows] @ vectors.T
            better = (found >= scores[rows, k - 1][:, None]).any(axis=1)
            for i in np.flatnonzero(better):
                u = rows[i]
                some = np.flatnonzero(found[i] >= scores[u, k - 1])
                all_scores = np.append(scores[u], found[i, some])
                all_ids = np.append(ids[u], block_ids[some])
                best = np.lexsort((all_ids, -all_scores))[:k]
                scores[u], ids[u] = all_scores[best], all_ids[best]
        go_on = np.zeros(len(users), dtype=bool)
        if self.next_norm >= 0:
            go_on[open_(np.arange(len(users)), self.next_norm)] = True
        return ids, scores, scored, go_on


def top_products(users: DataFrame, items: DataFrame, k: int, vector: str = "features",
                 id_col: str = "id") -> DataFrame:
    """(id, rank, item, score, blocks): the ``k`` best items of every user; the smaller item id wins
    a tie. ``blocks`` is how many blocks of items were scored for the user.

    Both tables hold (id, vector); rows without one of them, or with a component that is NULL, are
    left out. All vectors are of one length. Scores are exact products of doubles.
    """
    def usable(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).filter(
            F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull()))

    spark = users.sparkSession
    ranked = staged(ranges.numbered(
        usable(items).withColumn("norm", F.sqrt(_square("v"))),
        [F.col("norm").desc(), F.col("id").asc()], "place", "items"), "ranked-items")
    size = ranked.agg(F.count(F.lit(1))).first()[0]
    state = staged(usable(users).withColumns({
        "items": F.array().cast("array<bigint>"), "scores": F.array().cast("array<double>"),
        "blocks": F.lit(0).cast("bigint"), "go_on": F.lit(True)}), "users")
    done = []
    for start in range(0, size, ITEMS):
        part = ranked.filter(F.col("place").between(start, start + ITEMS)).orderBy("place").toArrow()
        width = len(part["v"][0])
        ids = part["id"].to_numpy()
        vectors = _rows_of(part["v"].combine_chunks(), width)
        norms = part["norm"].to_numpy()
        ahead = float(norms[ITEMS]) if len(ids) > ITEMS else -1.0  # the first item of the next round
        shared = spark.sparkContext.broadcast(
            _Round(ids[:ITEMS], vectors[:ITEMS], norms[:ITEMS], ahead))

        def work(batches: Iterator[pa.RecordBatch], shared=shared, width=width) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, USERS):
                    batch = whole.slice(at, USERS)
                    n = batch.num_rows
                    best_ids = np.zeros((n, k), dtype=np.int64)
                    best = np.full((n, k), -np.inf)
                    for i, (a, b) in enumerate(zip(batch["items"].to_pylist(), batch["scores"].to_pylist())):
                        best_ids[i, :len(a)], best[i, :len(b)] = a, b
                    best_ids, best, scored, go_on = shared.value.search(
                        _rows_of(batch["v"], width), best_ids, best, k)
                    held = [np.isfinite(row) for row in best]
                    yield pa.RecordBatch.from_arrays(
                        [batch["id"], batch["v"],
                         pa.array([r[h] for r, h in zip(best_ids, held)], pa.list_(pa.int64())),
                         pa.array([r[h] for r, h in zip(best, held)], pa.list_(pa.float64())),
                         pa.array(batch["blocks"].to_numpy() + scored), pa.array(go_on)],
                        names=["id", "v", "items", "scores", "blocks", "go_on"])

        state = staged(state.mapInArrow(work, state.schema), "users")
        shared.destroy()
        done.append(state.filter(~F.col("go_on")))
        state = state.filter("go_on")
        if state.isEmpty():
            break
    lists = state
    for part in done:
        lists = lists.unionByName(part)
    return lists.select("id", "blocks", F.posexplode(F.arrays_zip("items", "scores")).alias("p", "x")).select(
        "id", (F.col("p") + 1).alias("rank"), F.col("x.items").alias("item"),
        F.col("x.scores").alias("score"), "blocks")
