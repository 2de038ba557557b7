"""Hard negatives by cover trees against all pairs."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagwise.llm import negatives
from tests.llm import cases

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows: list[tuple]) -> list[tuple]:
    kept = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        kept.append((vec_id, whole, (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for i, (a, q, label) in enumerate(kept):
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), b, other == label)
                        for j, (b, v, other) in enumerate(kept) if j != i)
        for p, pid, _ in [s for s in scored if s[2]][:5]:
            fit = [s for s in scored if not s[2] and -30 * p <= -100 * s[0] <= -90 * p][:10]
            out.extend((a, pid, r, nid, -p, -n) for r, (n, nid, _) in enumerate(fit, 1))
    return out


def check(spark, rows: list[tuple]) -> None:
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows))


def vectors(n: int, clusters: int, spread: float, seed: int = 1, width: int = 8) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    return [(i, [float(x) for x in centres[i % clusters] + spread * rng.normal(size=width)], i % 3)
            for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(negatives, "CELL", 40)
    monkeypatch.setattr(negatives, "BLOCK", 25)
    monkeypatch.setattr(negatives, "ANCHORS", 2)


def test_one_block(spark):
    check(spark, vectors(500, 6, 0.4))


def test_many_cells_blocks_and_chunks(spark, small):
    check(spark, vectors(600, 5, 0.3) + [(1000 + i, [0.5] * 8, i % 3) for i in range(120)])


def test_ties_and_repeated_rows(spark, small):
    rows = [(i, [float(i % 2), 1.0, 0.5], i % 4) for i in range(150)]
    check(spark, rows + [(100, [1.0, 1.0, 0.5], 0)] * 3 + [(3, [1.0, 1.0, 0.5], 1)] * 4)


def test_rows_that_take_no_part(spark):
    rows = vectors(220, 3, 0.2) + [
        (None, [1.0] * 8, 1), (300, None, 1), (400, [1.0] * 8, None), (500, [1.0, None, 1.0], 1),
        (600, [1.0, float("nan")], 2), (700, [float("inf")] * 8, 2), (801, [], 1), (802, [2.0, 1.0], 1),
        (900, [0.0] * 8, 1), (1100, [-1.0] * 8, 1)]
    check(spark, rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in 1e6 * rng.normal(size=4)], i % 2) for i in range(150)]
    check(spark, rows)
    big = negatives.products(np.asarray([[2.0 ** 60, 1.0]]), np.asarray([2.0 ** 60, 3.0]), 2.0 ** 60)
    assert big.tolist() == [(1 << 63) - 1]


def test_few_of_a_label(spark):
    check(spark, [(100 * i, [1.0, 0.1 * i], i) for i in range(4)] + [(1, [0.5, 0.1], 1)])


def test_a_tree_covers_its_rows_and_prunes():
    rng = np.random.default_rng(2)
    centres = 300 * rng.normal(size=(40, 16))
    rows = np.floor(np.repeat(centres, 50, axis=0) + 5 * rng.normal(size=(2000, 16)))
    tree = negatives.CoverTree(rows)
    found = np.sort(np.concatenate(tree.rows))
    assert found.tolist() == list(range(2000))

    def under(node: int) -> np.ndarray:
        return np.concatenate([tree.rows[node], *(under(k) for k in tree.children[node])])

    for node in range(len(tree.centre)):
        away = tree._places[under(node)] - tree._places[tree.centre[node]]
        assert np.sqrt((away ** 2).sum(axis=1).max()) <= tree.radius[node] * (1 + 1e-9) + 1e-2
    q, seen = rows[7], []
    best = negatives.Best(5, -(1 << 62), 1 << 62)

    def visit(some, scores):
        seen.extend(some)
        best.offer(scores, some)

    tree.search(q, visit, lambda low, high: high >= best.floor)
    order = np.lexsort((np.arange(2000), -(rows @ q)))[:5]
    assert best.ids.tolist() == order.tolist() and len(seen) < 400


def test_empty_table(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(100, None, 1)], SCHEMA)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).count() == 0


def test_other_columns_do_not_matter(spark):
    rows = spark.createDataFrame(vectors(220, 4, 0.3), SCHEMA)
    plain = negatives.hard_negatives(rows)
    more = rows
    for name in ("row", "cell", "block", "v", "low", "high", "at", "slot", "chunk", "rank", "id"):
        more = more.withColumn(name, F.lit("clash"))
    assert cases.same_rows(plain, negatives.hard_negatives(more))
    other = rows.select(F.col("vec_id").alias("a.b"), F.col("embedding").alias("v"), F.col("label").alias("l"))
    assert cases.same_rows(plain, negatives.hard_negatives(other, "a.b", "l", "v"))
