"""Exact dedup by two passes over a Bloom filter.

Pass one marks the filter positions that two or more text hashes hit. Pass two sends only rows
whose positions are all marked through a shuffle; every other row passes straight on.

Defined results: NULL text is the empty text. Of equal texts the row with the largest id stays; a
NULL id is smaller than any other. Rows equal in id and text are one document: ``decide`` counts
them in ``group_size`` and returns one row, ``keep_one`` keeps one row. An empty table gives an
empty table; text length and other columns play no part.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwise.llm import bitmap
from lagwise.llm.common import column, packed, pick
from lagwise.sources.layers import staged


def _digest(text):
    return F.unhex(F.sha2(text, 256))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           bits: int = bitmap.BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document.

    What shuffles is a 32-byte digest and the id, of possible repeats only. The groups are written
    before they are joined back, so the planner knows their size and a group with a third of all
    rows can be split among tasks.
    """
    prints = staged(pick(docs, id_col, text_col).select(
        "doc_id", _digest(F.col("text")).alias("digest")), "digests")
    marked = bitmap.probe(prints, F.col("digest"),
                          bitmap.build(prints, F.col("digest"), bits, least=2), "maybe", bits)
    single = marked.filter(~F.col("maybe")).select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("size"))
    rows = staged(marked.filter("maybe").groupBy("digest", "doc_id").agg(
        F.count(F.lit(1)).alias("n")), "repeats")
    groups = staged(rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("size")), "groups")
    both = single.unionByName(rows.join(groups, "digest").select(*single.columns))
    return both.select("doc_id", "keep_id", F.col("size").alias("group_size"),
                       F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             bits: int = bitmap.BITS) -> DataFrame:
    """``docs`` without the later copies, all columns kept.

    Possible repeats are reduced to one row per digest with a partial reduction in each task, so a
    large group arrives as one row per task; the other rows do not move.
    """
    digest = _digest(F.coalesce(column(text_col), F.lit("")))
    rows = docs.select(packed(docs).alias("row"), digest.alias("digest"))
    marked = bitmap.probe(rows, F.col("digest"),
                          bitmap.build(rows, F.col("digest"), bits, least=2), "maybe", bits)
    key = F.col("row").getField(id_col)
    best = marked.filter("maybe").groupBy("digest").agg(
        F.max_by("row", F.struct(key.isNotNull(), key)).alias("row"))
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(best.select("row.*"))
