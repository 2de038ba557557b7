"""A Bloom filter as a table of bitmaps, built and probed with SQL functions only.

The filter has 2**bits bits whatever the input is, so its size as a broadcast is proven: 16 MiB at
the default. More keys than it was made for cost precision, never a result: callers always check
what the filter lets through.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.llm.common import column, packed
from lagwise.sources.layers import staged

BITS = 27
PROBES = 2
_BUCKET_BITS = 15  # bitmap_construct_agg fills 32,768 bits


def _positions(key: Column, bits: int) -> Column:
    return F.array(*(F.shiftrightunsigned(F.xxhash64(F.lit(i), key), 64 - bits)
                     for i in range(PROBES)))


def build(df: DataFrame, key: Column, bits: int = BITS, least: int = 1) -> DataFrame:
    """Bitmaps of the positions that at least ``least`` rows of ``df`` hit.

    Rows are counted per position before anything is grouped (a key with a third of all rows is
    one row per task), and what leaves the count is at most 2**bits rows.
    """
    hit = df.select(F.explode(_positions(key, bits)).alias("p")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    bitmaps = hit.groupBy(F.shiftright("p", _BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << _BUCKET_BITS) - 1)).alias("bits"))
    return staged(bitmaps, "bitmap")


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("long"), place.bitwiseAND(7).cast("int")) == 1


def probe(df: DataFrame, key: Column, bitmaps: DataFrame, flag: str,
          bits: int = BITS) -> DataFrame:
    """``df`` with a boolean column: false means that the key is not in the filter."""
    columns = df.columns
    spots = _positions(key, bits)
    df = df.select("*", *(spots[i].alias(f"{flag}_{i}") for i in range(PROBES)))
    found = F.lit(True)
    for i in range(PROBES):
        place = F.col(f"{flag}_{i}")
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"{flag}_bucket_{i}"),
                                          F.col("bits").alias(f"{flag}_bits_{i}")))
        df = df.join(side, F.shiftright(place, _BUCKET_BITS) == F.col(f"{flag}_bucket_{i}"), "left")
        found = found & F.coalesce(
            _is_set(F.col(f"{flag}_bits_{i}"), place.bitwiseAND((1 << _BUCKET_BITS) - 1)),
            F.lit(False))
    return df.select(*columns, found.alias(flag))


def split_by_ids(docs: DataFrame, id_col: str, ids: DataFrame, bits: int = BITS
                 ) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in ``ids.doc_id``, rows whose id surely is not), as (doc_id, row).

    Only the first part needs a join: the second keeps its place, whatever the texts weigh.
    """
    rows = docs.select(column(id_col).alias("doc_id"), packed(docs).alias("row"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    marked = probe(rows, key, build(ids, key, bits), "maybe", bits)
    return (marked.filter("maybe").select("doc_id", "row"),
            marked.filter(~F.col("maybe")).select("doc_id", "row"))


def without_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``ids.doc_id`` (a written table)."""
    maybe, never = split_by_ids(docs, id_col, ids)
    left = maybe.join(ids.select("doc_id"), "doc_id", "left_anti")
    return never.select("row.*").unionByName(left.select("row.*"))


def only_ids(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids.doc_id`` (a written table)."""
    maybe, _ = split_by_ids(docs, id_col, ids)
    return maybe.join(ids.select("doc_id"), "doc_id", "left_semi").select("row.*")
