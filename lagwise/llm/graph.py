"""Connected components of a table of links."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise.llm.common import slices, tidy
from lagwise.sources.layers import staged


#: Edges that one step of a task links in its memory.
CHUNK = 1 << 17


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components, v < u: of each chunk that a task reads, every vertex and
    the smallest one that the chunk links it to. A vertex is ``u`` at most once per chunk."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}  # a vertex that is not the smallest: a smaller one

        def top(x):
            while (up := above.get(x)) is not None:
                if (next_up := above.get(up)) is not None:
                    above[x] = next_up
                x = up
            return x

        def rows(kinds: list[pa.DataType]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(above), kinds[0]), pa.array([top(x) for x in above], kinds[1])],
                names=["u", "v"])

        for batch in slices(batches, CHUNK):
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = top(a), top(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
            if len(above) >= CHUNK:
                yield rows(batch.schema.types)
                above.clear()
        if above:
            yield rows(batch.schema.types)

    return edges.mapInArrow(work, edges.schema)


def _stars(edges: DataFrame) -> bool:
    """Whether each vertex is ``u`` once at most, and no ``u`` is a ``v``: then v are the labels."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    of_vertex = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return of_vertex.filter("out > 1 OR out = 1 AND into = 1").isEmpty()


def _lowest(links: DataFrame) -> DataFrame:
    return staged(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "lowest")


@tidy
def components(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex reachable from each vertex of ``links`` (a, b).

    Tasks link what they read in chunks of a fixed size; edges that fit in one chunk are so done in
    one step. What several chunks share is linked by alternating large-star and small-star steps:
    each links the neighbours of a vertex to the smallest of them, until every vertex points at its
    label. A step is a partial minimum and a join on two written tables, so a vertex with very many
    neighbours is split among tasks.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v"), "links")
    while True:
        size = edges.count()
        if size <= CHUNK:  # as little as any task may hold
            edges = staged(_forest(edges.coalesce(1)), "links")
            break
        edges = staged(_forest(edges), "links")
        if _stars(edges):
            break
        both = staged(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))),
                      "links")
        large = both.join(_lowest(both), "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = staged(large, "links")
        small = large.join(_lowest(large), "u")
        edges = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
    found = edges.select(F.col("u").alias("v"), F.col("v").alias("label"))
    return staged(found.unionByName(found.select(
        F.col("label").alias("v"), "label").distinct()), "components")
