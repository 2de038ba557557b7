"""Line dedup over overlapping three-line windows.

The lines of a text that hold a word are numbered; each three in a row are a window, known by a
128-bit hash. Windows that occur twice or more anywhere are found by one aggregation, with partial
sums in every task, so a passage that a third of all texts share is one row per task. All
occurrences but the first, in order of document id and place, are later ones; the places they cover
are merged per text, and these lines go. Lines without a word stay.

A Bloom filter of the repeated windows keeps all others out of the join, and one of the affected
documents keeps the texts of all others where they are.

Defined results: NULL and empty texts, and texts of fewer than three lines with words, keep all
lines (NULL becomes the empty text). Inside a text a later occurrence may overlap the first; lines
that it covers go all the same. Rows equal in id and text are one document and lose the same
lines; rows that only share the id are ordered by a hash of their text. A NULL id comes before all
others. An empty table gives an empty table. Texts of any length are read whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.llm import bitmap
from lagwise.llm.common import SPACE, column, packed
from lagwise.sources.layers import staged

WINDOW = 3


def _has_word(line: Column) -> Column:
    return line.rlike(f"[^{SPACE}]")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, version, place, h1, h2) of (doc_id, text)."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"),
                        F.filter(F.split("text", "\n"), _has_word).alias("lines"))

    def hashes(line: Column, i: Column) -> Column:
        parts = [line, *(F.get("lines", i + k) for k in range(1, WINDOW))]
        return F.struct(i.alias("place"), F.xxhash64(*parts).alias("h1"),
                        F.xxhash64(F.lit(WINDOW), *parts).alias("h2"))

    starts = F.slice("lines", F.lit(1), F.greatest(F.size("lines") - (WINDOW - 1), F.lit(0)))
    return lines.select("doc_id", "version", F.inline(F.transform(starts, hashes)))


def later_places(docs: DataFrame) -> DataFrame:
    """(doc_id, version, places): the starts of later occurrences in each affected text."""
    found = windows(docs)
    here = F.struct("doc_id", "version", "place")
    repeated = staged(found.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min(here).alias("first")).filter("n > 1").select(
        F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first"), "windows")
    maybe = bitmap.probe(found, F.col("h1"), bitmap.build(repeated, F.col("r1")), "maybe")
    later = maybe.filter("maybe").drop("maybe").join(
        repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).filter(
        here > F.col("first"))
    return staged(later.groupBy("doc_id", "version").agg(
        F.collect_set("place").alias("places")), "later-lines")


def _worded_places(lines: Column) -> Column:
    """Places in the text of the lines that hold a word; window places count along this list."""
    return F.array_compact(F.transform(lines, lambda x, i: F.when(_has_word(x), i)))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, text, n_lines, n_removed): every row of ``docs`` with its cleaned text."""
    rows = docs.select(column(id_col).alias("doc_id"), packed(docs).alias("row"),
                       F.coalesce(column(text_col), F.lit("")).alias("text"))
    later = later_places(rows.select("doc_id", "text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    marked = bitmap.probe(rows, key, bitmap.build(later, key), "maybe")
    worded = F.size(F.filter(F.split("text", "\n"), _has_word)).cast("long")
    same = marked.filter(~F.col("maybe")).select(
        "doc_id", "row", "text", worded.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    place = later.select(F.col("doc_id").alias("l_id"), F.col("version").alias("l_version"), "places")
    joined = marked.filter("maybe").withColumn("version", F.xxhash64("text")).join(
        place, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("version") == F.col("l_version")),
        "left")
    split = joined.withColumn("lines", F.split("text", "\n")).withColumn(
        "worded", _worded_places(F.col("lines")))
    gone = F.flatten(F.transform("places", lambda p: F.slice("worded", p + 1, F.lit(WINDOW))))
    left = split.withColumn("left", F.array_except(
        F.sequence(F.lit(0), F.size("lines") - 1),
        F.coalesce(gone, F.array().cast("array<int>"))))
    changed = left.select(
        "doc_id", "row", F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias(
            "text"),
        F.size("worded").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_removed"))
    return same.unionByName(changed)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later occurrences cut out of the text."""
    found = cleaned(docs, id_col, text_col)
    text = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row").getField(text_col))
    return found.select(*(text.alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                          for c in docs.columns))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, text_sha256 (of the cleaned text)."""
    return cleaned(docs, id_col, text_col).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))
