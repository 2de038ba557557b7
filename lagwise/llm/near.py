"""MinHash near-dedup by an inverted join on signature coordinates.

A document's signature holds, per coordinate, the smallest of its shingles' hashes. Every signature
is posted under its 64 coordinate-value pairs. Two documents count as candidates if at least
``LEAST`` pairs collide, and the counting is done as a merge with prefix and skipping: pairs are
ordered from rare to common, documents meet only in the posting lists of their
``COORDINATES - LEAST + 1`` rarest pairs (two documents with enough collisions share one of these),
and the long lists are skipped, their collisions being counted by looking into the two signatures.
Candidates are confirmed on the full shingle sets.

A link of similarity 0.75 has fewer than 30 of 64 collisions with a probability of about 1e-6.

Not all pairs of a group are made. Documents with equal shingle sets are one class. Each list first
meets only two of its members: one drawn by hash, and the central one, whose pairs are the most common
(in a group of copies, the one with the fewest edits). Classes that are still in different components
after that meet each other in their rarest shingles, and only pairs that can differ little enough come
out of that join: ``parity`` bounds from below in how many shingles two sets differ, so no link is ruled
out. Components need no more, and no link between different components is lost. Above some 3,000
shingles the bound says little; there the signatures decide after the join.

Defined results: NULL text, or text without words: no shingles, linked with nothing. A NULL id is
linked with nothing; its component is NULL and it is kept. Rows with equal ids are linked by their
texts like others. Texts of any length are read whole. An empty table gives an empty table.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lagwise.llm import bitmap
from lagwise.llm.common import id_type, pick, slices, tidy
from lagwise.llm.graph import components
from lagwise.llm.tokens import ChunkCache, held
from lagwise.sources.layers import scope, staged

WORDS = 5
COORDINATES, LEAST = 64, 30
#: Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: 64-bit words of a set's parities.
PARITIES = 16

_MIX = np.random.default_rng(20240501)
_PLACE = _MIX.integers(1 << 63, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _MIX.integers(1 << 63, size=(COORDINATES, 1), dtype=np.uint64)
_TURN = _MIX.integers(1 << 63, size=(COORDINATES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _word_hashes() -> ChunkCache:
    return held("word hashes", lambda: ChunkCache(xxhash.xxh64_intdigest, 1 << 16))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < WORDS:
        return np.asarray([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))],
                          dtype=np.uint64)
    of_word = _word_hashes()
    hashes = np.asarray([of_word[w] for w in words], dtype=np.uint64)
    n = len(hashes) - WORDS + 1
    mixed = hashes[:n] * _PLACE[0]
    for i in range(1, WORDS):
        mixed += hashes[i:i + n] * _PLACE[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """The smallest hash per coordinate (its upper 32 bits)."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 2048):
        turned = (found[at:at + 2048] ^ _FLIP) * _TURN
        np.minimum(best, turned.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def parity(found: np.ndarray) -> np.ndarray:
    """Per bin of hashes, whether an odd number of the shingles falls in it. Bins in which two sets
    disagree are at most as many as the shingles that only one of them has."""
    bins = PARITIES * 64
    odd = np.bincount((found >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets), signature; the last two NULL if empty."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, keys, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                keys.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                signatures.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(signatures, pa.list_(pa.int32()))],
                names=["doc_id", "n_shingles", "set_key", "signature"])

    return docs.mapInArrow(work, f"doc_id {id_type(docs)}, n_shingles long, set_key binary, "
                                 "signature array<int>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(rep, shingles, parity): the set of each text, and the class it names."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([parity(s) for s in sets], pa.list_(pa.int64()))],
                names=["rep", "shingles", "parity"])

    return docs.mapInArrow(work, "rep binary, shingles array<long>, parity array<long>")


@tidy
def class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, shingles, parity) of the ``wanted`` classes (rep, written): one text of each is read.

    An id can have several texts; only those of a wanted class stay.
    """
    ids = staged(wanted.join(classes.select("rep", "doc_id"), "rep").select("doc_id"), "wanted-ids")
    sets = shingle_sets(bitmap.only_ids(docs, "doc_id", ids))
    return staged(staged(sets, "read-sets").join(wanted, "rep", "left_semi").dropDuplicates(["rep"]),
                  "sets")


def _posted(classes: DataFrame) -> DataFrame:
    """(rep, key): one row per class and coordinate-value pair."""
    pairs = classes.select("rep", F.posexplode("signature").alias("place", "value"))
    key = F.shiftleft(F.col("place").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(
        0xFFFFFFFF)
    return pairs.select("rep", key.alias("key"))


@tidy
def prefixes(classes: DataFrame) -> DataFrame:
    """(rep, key, central): the posting lists in which each class is met, and how many other classes
    its pairs are shared with in all.

    Pairs that occur once can collide with nothing. They are the rarest, so they come first in the
    prefix: of a class with m other pairs, the m - LEAST + 1 rarest of these remain.
    """
    posted = _posted(classes)
    common = staged(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "pairs")
    maybe = bitmap.probe(posted, F.col("key"), bitmap.build(common, F.col("key")), "maybe")
    shared = staged(maybe.filter("maybe").select("rep", "key"), "postings").join(common, "key")
    listed = shared.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("l"))
    central = F.aggregate("l", F.lit(0).cast("long"), lambda total, p: total + p["n"])
    return staged(listed.filter(F.size("l") >= LEAST).select("rep", central.alias("central"), F.explode(
        F.slice("l", F.lit(1), F.size("l") - (LEAST - 1))).alias("p")).select(
        "rep", "p.key", "central"), "prefixes")


def _collisions(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0),
                       lambda acc, x: acc + x)


def _sizes_allow(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _parities_allow(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Links share 3/7 of n_a + n_b at least, so they differ in 1/7 of it at most."""
    apart = reduce(add, (F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(PARITIES)))
    return (100 + SIMILARITY) * apart <= (100 - SIMILARITY) * (n_a + n_b)


@tidy
def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame,
              sets: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Without ``sets`` of them, only texts whose id passes the filter of all wanted ids are read into sets.
    """
    if sets is None:
        wanted = staged(pairs.select(F.col("a").alias("rep")).unionByName(
            pairs.select(F.col("b").alias("rep"))).distinct(), "wanted")
        sets = class_sets(docs, classes, wanted)
    both = staged(pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")),
                             "a"), "left-sets").join(
        sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return staged(both.filter(100 * common >= SIMILARITY * (F.size("x") + F.size("y") - common))
                  .select("a", "b"), "links")


@tidy
def _candidates(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those with enough collisions and possible sizes."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("rep").alias(name), F.col("signature").alias(f"s_{name}"),
                              F.col("n_shingles").alias(f"n_{name}"))

    met = staged(pairs.join(side("a"), "a"), "met").join(side("b"), "b")
    return staged(met.filter(_sizes_allow(F.col("n_a"), F.col("n_b")) & (
        _collisions(F.col("s_a"), F.col("s_b")) >= LEAST)).select("a", "b"), "candidates")


def _rare_prefixes(sets: DataFrame) -> DataFrame:
    """(rep, gram, n_shingles, short) of the shingles in which a set is met by others.

    Shingles are ordered from rare to common. Similar sets share so much that the rarest quarter
    of the larger one meets the rarest seventh of the smaller one (``short``); shingles that occur
    in one set come first in this order and meet nothing.
    """
    grams = sets.select("rep", F.size("shingles").alias("n_shingles"),
                        F.explode("shingles").alias("gram"))
    common = staged(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "grams")
    size, shared = F.col("n_shingles"), F.size("l")
    # Overlap of at least 3/4 of the larger set, and 6/7 of the smaller one.
    quarter = size - F.ceil(size * SIMILARITY / 100).cast("int") + 1 - (size - shared)
    seventh = size - F.ceil(size * (2 * SIMILARITY) / (100 + SIMILARITY)).cast("int") + 1 - (
        size - shared)
    lists = staged(grams, "set-grams").join(common, "gram").groupBy("rep", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("l"))
    return lists.select("rep", "n_shingles", F.posexplode(
        F.slice("l", F.lit(1), F.greatest(quarter, F.lit(0)))).alias("at", "p"),
        seventh.alias("seventh")).select(
        "rep", "n_shingles", "p.gram", (F.col("at") < F.col("seventh")).alias("short"))


def _across(docs: DataFrame, classes: DataFrame, lists: DataFrame, label: DataFrame
            ) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) in different components that can still be links, and the sets of their classes.

    Only members of posting lists with several components are looked at. Their lists are long
    where many texts share a passage, and pairs of such texts would be very many, so they meet in
    their rarest shingles instead, which for texts with enough of their own are not the passage.
    """
    with scope(docs.sparkSession) as steps:
        known = staged(lists.join(label, lists["rep"] == label["v"], "left").select(
            "key", "rep", F.coalesce("label", "rep").alias("label")), "labelled")
        mixed = staged(known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                       .filter("low <> high").select("key"), "mixed")
        reps = staged(known.join(mixed, "key", "left_semi").select("rep", "label").distinct(), "open")
        sets = class_sets(docs, classes, reps)
        met = _rare_prefixes(sets).join(reps, "rep")
        met = staged(met.select("gram", "rep", "label", "n_shingles", "short"), "met-grams")
        several = staged(met.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                         .filter("low <> high").select("gram"), "mixed-grams")
        met = staged(met.join(several, "gram", "left_semi"), "met-grams").join(
            sets.select("rep", "parity"), "rep")
        met = staged(met, "met-parities")
        a, b = (met.select("gram", *(F.col(c).alias(f"{c}_{s}") for c in met.columns if c != "gram"))
                for s in "ab")
        smaller = (F.col("n_shingles_a") < F.col("n_shingles_b")) | (
            (F.col("n_shingles_a") == F.col("n_shingles_b")) & (F.col("rep_a") < F.col("rep_b")))
        pairs = a.filter("short_a").join(
            b, (a["gram"] == b["gram"]) & (F.col("label_a") != F.col("label_b")) & smaller
            & _sizes_allow(F.col("n_shingles_a"), F.col("n_shingles_b"))
            & _parities_allow(F.col("parity_a"), F.col("parity_b"),
                              F.col("n_shingles_a"), F.col("n_shingles_b")))
        pairs = staged(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(),
                       "across")
        steps.keep(pairs, sets)
    return pairs, sets


@tidy
def labels(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(v, label): the smallest class reachable by links, of the classes that have any."""
    lists = prefixes(classes)
    heads = staged(lists.groupBy("key").agg(
        F.max_by("rep", F.struct("central", "rep")).alias("central"),
        F.min_by("rep", F.xxhash64("rep")).alias("any")), "heads")
    stars = lists.select("rep", "key").join(heads, "key").select(
        F.col("rep").alias("a"), F.explode(F.array("central", "any")).alias("b")).filter(
        "a <> b").distinct()
    label = components(confirmed(docs, classes, _candidates(stars, classes)))
    pairs, sets = _across(docs, classes, lists, label)
    close = _candidates(pairs, classes)
    more = close if close.isEmpty() else confirmed(docs, classes, close, sets)
    if more.isEmpty():
        return label
    return components(more.unionByName(label.select(F.col("v").alias("a"), F.col("label").alias("b"))))


def _decided(docs: DataFrame) -> DataFrame:
    """doc_id, set_key, n_shingles, component_id, kept of (doc_id, text)."""
    with scope(docs.sparkSession) as steps:
        rows, named = _classes_named(docs)
        steps.keep(rows, named)
    found = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(
        F.coalesce("label", "doc_id"))
    return found.select("doc_id", "set_key", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


def _classes_named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and the smallest document id (label) of each class's component."""
    rows = staged(sketches(docs), "sketches")
    some = rows.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    # An id may have several texts, so a class is named by its set and not by an id.
    classes = staged(some.groupBy(F.col("set_key").alias("rep")).agg(
        F.min("doc_id").alias("doc_id"),
        F.min_by(F.struct("n_shingles", "signature"), "doc_id").alias("of")
    ).select("rep", "doc_id", "of.*"), "classes")
    label = labels(docs, classes)
    joined = staged(classes.select("rep", "doc_id").join(
        label, F.col("rep") == label["v"], "left").select(
        F.col("rep").alias("set_key"), "doc_id", F.coalesce("label", "rep").alias("group")), "groups")
    named = staged(joined.join(joined.groupBy("group").agg(F.min("doc_id").alias("label")), "group")
                   .select("set_key", "label"), "class-labels")
    return rows, named


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row."""
    return _decided(pick(docs, id_col, text_col)).drop("set_key")


def _with_class(rows: DataFrame, text_col: str) -> DataFrame:
    """(doc_id, row) with the class of the row's text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t) for t in batch.column(2).to_pylist()]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.binary())],
                                             names=["doc_id", "row", "set_key"])

    text = F.coalesce(F.col("row").getField(text_col), F.lit("")).alias("text")
    return rows.select("doc_id", "row", text).mapInArrow(work, StructType(
        [*rows.schema.fields, StructField("set_key", BinaryType())]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, all columns kept.

    Of an id with several texts, only the texts that are near copies go.
    """
    gone = staged(_decided(pick(docs, id_col, text_col)).filter(~F.col("kept")).select(
        "doc_id", "set_key").distinct(), "near-copies")
    maybe, never = bitmap.split_by_ids(docs, id_col, gone)
    left = _with_class(maybe, text_col).join(gone, ["doc_id", "set_key"], "left_anti")
    return never.select("row.*").unionByName(left.select("row.*"))
