"""A Merkle manifest of a table: a leaf per row, a tree per source, a tree over the sources.

A tree is built level by level. The nodes of a level are numbered from 0, three in a row are one run,
and the last run may be shorter. Lag and lead by one and two, masked by a node's slot in its run and
by the run's length, give each node its siblings; the node in slot 0 of a run hashes the parent. A
level is a written table a third as long as the one below, so all of them weigh half of the leaves.

Windows go over blocks of 3^7 neighbouring nodes of one source, never over a source: runs do not cross
blocks. Leaves are numbered in ranges of (source, id), shifted by the counts of earlier ranges, so a
source with a third of all rows is many ranges and many blocks. Texts are hashed where they are read;
only digests are shuffled.

Defined results: a NULL or empty value has its own form in the leaf (``-`` and ``0:``). A NULL source
is a source, the first one. A NULL id comes before all ids of its source and counts as the empty text
where ids are drawn. Rows of one source with equal ids are ordered by their digests; rows equal in
all columns are leaves of their own with the same digest, and their order does not matter. An empty
table has no root and gives an empty table. Texts of any length are read whole. Other columns are
not read.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.llm.common import column
from lagwise.sources.layers import staged

#: Children of a node.
ARITY = 3
#: Nodes of one window: a power of ``ARITY``, so that runs lie in one block.
BLOCK = ARITY ** 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def drawn(doc_id: Column, one_in: int) -> Column:
    """Whether the CRC-32 of the decimal id is divisible by ``one_in``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % one_in == 0


def leaves(docs: DataFrame, group: str = "source", key: str = "doc_id",
           fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None) -> DataFrame:
    """grp, key, node, seen: the leaf of every row, and the leaf of the row with its ``changed``
    columns in place of the original ones (the same leaf if nothing is given)."""
    node = digest(*(field(column(f)) for f in fields))
    seen = node if not changed else digest(*(field(changed.get(f, column(f))) for f in fields))
    return docs.select(column(group).cast("string").alias("grp"), column(key).alias("key"),
                       node.alias("node"), seen.alias("seen"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, key, node, ...) with ``pos``, the place in the group from 0 by key and node, and
    ``size``, the number of rows of the group."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The row's number only spreads rows that are equal in all else.
    order = [F.col(c).asc_nulls_first() for c in ("grp", "key", "node", "row")]
    ranged = staged(rows.withColumn("row", F.monotonically_increasing_id())
                    .repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
                    "merkle-ranges")
    counts = ranged.groupBy(F.struct("grp").alias("g"), "part").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("g")  # at most one row per range
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(counts.select("g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                                  F.sum("n").over(group).alias("size")), "merkle-starts")
    inside = F.row_number().over(Window.partitionBy("g", "part").orderBy(*order)) - 1
    placed = ranged.withColumn("g", F.struct("grp")).withColumn("inside", inside)
    return placed.join(starts, ["g", "part"]).select(
        *rows.columns, (F.col("start") + F.col("inside")).alias("pos"), "size")


def with_siblings(level: DataFrame) -> DataFrame:
    """Nodes (grp, pos, size, node) with what their run holds ``before`` and ``after`` each."""
    window = (Window.partitionBy(F.struct("grp"), F.floor(F.col("pos") / BLOCK)).orderBy("pos"))
    slot = F.col("pos") % ARITY
    run = F.least(F.lit(ARITY), F.col("size") - (F.col("pos") - slot))  # its length
    none = F.lit("")
    before = [F.when(slot >= k, F.lag("node", k).over(window)).otherwise(none)
              for k in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("node", k).over(window)).otherwise(none)
             for k in range(1, ARITY)]
    return level.withColumns({"before": F.concat(*before), "after": F.concat(*after)})


def parents(level: DataFrame) -> DataFrame:
    """The nodes above, hashed by the first child of each run; groups of one node are done."""
    return level.filter((F.col("size") > 1) & (F.col("pos") % ARITY == 0)).select(
        "grp", F.floor(F.col("pos") / ARITY).alias("pos"),
        F.ceil(F.col("size") / ARITY).alias("size"), digest(F.col("node"), F.col("after")).alias("node"))


@dataclass(frozen=True)
class Forest:
    """Written tables: one per level, lowest first, each (grp, pos, size, node, before, after) and
    the lowest with the columns of the leaves."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """(grp, node): what remains of each group."""
        found = [level.filter("size = 1").select("grp", "node") for level in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def paths(self) -> DataFrame:
        """The leaves with ``path``, the siblings of each step to the group's root from below.

        Goes down: a node's path is its own step and the path of its parent. A join is on the
        parent's place, which at most three rows share, and its other side is a third as long.
        """
        step = F.struct("before", "after")
        empty = F.expr("CAST(array() AS array<struct<before: string, after: string>>)")
        above = None
        for level in reversed(self.levels):
            rest = empty
            if above is not None:
                up = above.select(F.col("g"), F.col("pos").alias("up"), F.col("path").alias("rest"))
                level = level.withColumns({"g": F.struct("grp"), "up": F.floor(F.col("pos") / ARITY)}) \
                    .join(up, ["g", "up"], "left")
                rest = F.coalesce("rest", empty)
            own = F.when(F.col("size") > 1, F.array(step)).otherwise(empty)
            above = level.withColumns({"g": F.struct("grp"), "path": F.concat(own, rest)})
        return above.drop("g", "up", "rest", "before", "after")


def forest(numbered_leaves: DataFrame) -> Forest:
    """The trees of all groups; takes as many rounds as the largest group has levels."""
    levels = [staged(with_siblings(numbered_leaves), "merkle-level")]
    most = levels[0].agg(F.max("size")).first()[0] or 0
    while most > 1:
        levels.append(staged(with_siblings(parents(levels[-1])), "merkle-level"))
        most = -(-most // ARITY)
    return Forest(levels)


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, node, lambda at, s: digest(s["before"], at, s["after"]))


def siblings_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``sources``: the trees of the sources; ``top``: the tree over their roots."""

    sources: Forest
    top: Forest

    def root(self) -> DataFrame:
        """One row with the root, none for an empty table."""
        return self.top.roots().select(F.col("node").alias("root"))

    def nodes(self) -> DataFrame:
        """source, level, pos, node of every source's tree."""
        out = None
        for i, level in enumerate(self.sources.levels):
            rows = level.select(F.col("grp").alias("source"), F.lit(i).alias("level"), "pos", "node")
            out = rows if out is None else out.unionByName(rows)
        return out

    def proofs(self) -> DataFrame:
        """The leaves with ``source``, ``subroot``, ``root`` and ``path`` from the leaf to the root."""
        over = self.top.paths().select(F.struct(F.col("key").alias("grp")).alias("g"),
                                       F.col("node").alias("subroot"), F.col("path").alias("over"))
        roots = self.root().withColumn("one", F.lit(1))
        over = over.withColumn("one", F.lit(1)).join(F.broadcast(roots), "one").drop("one")  # one row
        found = self.sources.paths().withColumn("g", F.struct("grp")).join(over, "g")
        return found.drop("g").withColumnRenamed("grp", "source").withColumn(
            "path", F.concat("path", "over")).drop("over", "pos", "size")


def manifest(leaf_rows: DataFrame) -> Manifest:
    """The manifest of rows as :func:`leaves` gives them."""
    sources = forest(numbered(leaf_rows))
    tops = sources.roots().select(F.lit(0).cast("string").alias("grp"), F.col("grp").alias("key"), "node")
    return Manifest(sources, forest(numbered(tops)))


def verified(proofs: DataFrame) -> DataFrame:
    """``proofs`` with the root folded from the leaf that was ``seen``, and whether it is the root."""
    return proofs.withColumn("folded_root", folded(F.col("seen"), F.col("path"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def tamper_check(docs: DataFrame, one_in: int = 2) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, where the texts
    of one in ``one_in`` ids are read back without their line ends."""
    text = F.when(drawn(F.col("doc_id"), one_in), F.translate("text", "\n", "")).otherwise(F.col("text"))
    proofs = manifest(leaves(docs, changed={"text": text})).proofs()
    return verified(proofs).select(
        F.col("key").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root",
        siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
