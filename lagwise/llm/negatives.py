"""Hard negatives for labelled vectors by cover trees over norm-augmented candidates.

A row's score for an anchor is an integer inner product. With one more component,
sqrt(M^2 - |x|^2) with M the largest norm, all candidates have the norm M, and the score falls as the
distance to the anchor grows: 2 * score = |q|^2 + M^2 - distance^2. A node of a cover tree knows its
centre and its covering radius, the distance to the farthest row under it, so the scores under it
lie between those of distance + radius and distance - radius.

Candidates are dealt to cells by their nearest pivot, and cells to blocks of about ``BLOCK`` rows, so
neither a dense region nor one row repeated many times fills a task. Each block is one cover tree,
built where it is searched. A cell has a covering radius, too: an anchor goes only to the cells whose
bounds leave something to find. In a block, an anchor's search is best first: the node with the
highest bound is opened next, nodes outside of all windows still open are skipped, and what is
reached is verified with exact integer scores. Blocks give their best rows, which are few, and these
are ranked per anchor.

First the positives are searched: an anchor meets one block of its own cell, and the score of its last
positive there tells which other cells it must see. Then all windows of an anchor are searched together.

Bounds on what the driver or a task holds: ``PIVOTS`` pivots, a summary row for each cell, ``BLOCK``
candidates (twice that if a cell is dealt unevenly) and ``ANCHORS`` anchors. Candidates are sent once
per ``ANCHORS`` anchors. Pivots are a sample by a hash of the rows; they steer the work and not the
result.

Defined results: rows with a NULL id, label or vector, or a NULL or non-finite component take no part.
Vectors of different lengths are filled up with zeros; an empty vector is all zeros; components
are below 1e150. Rows that repeat
an id are candidates of their own and rank by score and id alone, so which of them comes first does not
matter; an anchor row is never its own positive, but another row with its id is. A negative or zero
positive score leaves no window or the scores of zero. Scores beyond 2^53 are added exactly, too; beyond
a long they are held at its ends. An empty table gives an empty table. Other columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagwise.llm.common import column
from lagwise.sources.layers import staged

#: Most pivots (one per ``CELL`` rows), rows of a block, and anchors of a task.
PIVOTS, CELL, BLOCK, ANCHORS = 512, 4096, 4096, 16384
#: Radii shrink by this factor from a level to the next; nodes of at most ``LEAF`` rows are not split.
SHRINK, LEAF = 1.5, 16
SCALE = 256
#: What rounding may add to a bound, as a share of the squared norms; centres tried in one product.
SLACK, _TRIED = 1e-6, 64
#: Nodes that a search opens together at first.
FIRST = 256
_LONG = (1 << 63) - 1


def candidates(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
               vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(vec_id, label, v): the rows that take part, with ``v`` the floor of 256 times each component."""
    named = vectors.select(column(id_col).cast("long").alias("vec_id"),
                           column(label_col).cast("long").alias("label"),
                           F.transform(column(vector_col), lambda x: x.cast("double")).alias("v"))
    infinite = F.lit(float("inf"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    kept = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                        & F.col("v").isNotNull()).filter(fine)
    if label is not None:
        kept = kept.withColumn("label", label)
    # A double: floor() of Spark is a long, which large components leave.
    scaled = kept.withColumn("v", F.transform("v", lambda x: x * F.lit(float(SCALE))))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.float64()))],
                names=["vec_id", "label", "v"])

    return scaled.mapInArrow(floors, "vec_id long, label long, v array<double>")


def matrix(lists, width: int) -> np.ndarray:
    """Rows of equal length; shorter ones are filled up with zeros."""
    if len(lists) and all(len(x) == width for x in lists):
        return np.asarray(np.stack(lists), dtype=np.float64)
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def products(rows: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products; exact, and held at the ends of a long. No component of ``rows`` is
    larger than ``largest``."""
    if largest * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2.0 ** 53:
        return (rows @ q).astype(np.int64)
    whole = [int(x) for x in q]
    return np.asarray([max(-_LONG - 1, min(_LONG, sum(int(a) * b for a, b in zip(row, whole))))
                       for row in rows], dtype=np.int64)


class CoverTree:
    """A cover tree over the rows of a block.

    A node is a centre (a row), a covering radius, children and leaf rows. On each level a centre is
    farther from the earlier ones than the level's radius, and takes all rows within that radius. A
    centre that takes nothing but itself is a leaf row of the node above.
    """

    def __init__(self, vectors: np.ndarray):
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.vectors, self.most = vectors, float(norms.max(initial=0.0))
        self.largest = float(np.abs(vectors).max(initial=0.0))
        lift = np.sqrt(np.maximum(self.most - norms, 0.0))
        self._places = np.column_stack([vectors, lift])  # all of the same norm
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        if len(vectors):
            self._grow()
        # Flat: the leaf rows of a node are neighbours, and so are its children.
        self.centres, self.radii = vectors[np.asarray(self.centre, dtype=np.int64)], np.asarray(self.radius)
        self.order = np.concatenate([np.zeros(0, dtype=np.int64), *self.rows])
        self.sorted = vectors[self.order]
        self.leaf_ends = np.cumsum([0] + [len(r) for r in self.rows])
        self.first_kid = np.asarray([c[0] if c else 0 for c in self.children], dtype=np.int64)
        self.n_kids = np.asarray([len(c) for c in self.children], dtype=np.int64)

    def _add(self, rows: np.ndarray, radius: float) -> int:
        self.centre.append(int(rows[0]))
        self.radius.append(radius)
        self.children.append([])
        self.rows.append(rows[:0])
        return len(self.centre) - 1

    def _squares(self, some: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Squared distances, from products, as all places have the same norm."""
        return np.maximum(2 * (self.most - some @ to.T), 0.0)

    def _grow(self) -> None:
        rows = np.arange(len(self.vectors))
        far = self._squares(self._places, self._places[:1]).max()
        open_ = [(self._add(rows, float(np.sqrt(far))), rows)]
        same = 1e-7 * math.sqrt(self.most)  # nearer than this is what rounding leaves of one place
        while open_:
            node, rows = open_.pop()
            if len(rows) <= LEAF or self.radius[node] <= same:
                self.rows[node] = rows
                continue
            reach, alone = (self.radius[node] / SHRINK) ** 2, []
            while len(rows):
                places, left = self._places[rows], np.ones(len(rows), dtype=bool)
                while 2 * left.sum() >= len(rows):  # else go on with what is left
                    tried = np.flatnonzero(left)[:_TRIED]
                    squares = self._squares(places, places[tried])
                    for j, c in enumerate(tried):
                        if not left[c]:
                            continue
                        near = left & (squares[:, j] <= reach)
                        near[c] = False
                        others = np.flatnonzero(near)
                        left[c] = False
                        if not len(others):
                            alone.append(rows[c])
                            continue
                        left[others] = False
                        some = rows[np.append(c, others)]
                        child = self._add(some, float(np.sqrt(squares[others, j].max())))
                        self.children[node].append(child)
                        open_.append((child, some))
                    if not left.any():
                        break
                rows = rows[left]
            self.rows[node] = np.asarray(alone, dtype=np.int64)

    def search(self, q: np.ndarray, visit: Callable[[np.ndarray, np.ndarray], None],
               wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> int:
        """Opens nodes best first and gives ``visit`` (rows, scores) of all leaf rows reached.

        ``wanted`` tells of (lowest, highest) bounds which of them may hold something that is still
        looked for. The nodes with the highest bounds are opened together, a few at first and twice
        as many each time. Returns how many nodes were opened.
        """
        if not len(self.vectors):
            return 0
        base = float(q @ q) + self.most
        slack = SLACK * base + 0.5

        whole: dict[str, np.ndarray] = {}

        def scored(kind: str, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Scores of some rows; if they are many, all are scored once, without a copy."""
            if kind not in whole and 4 * len(at) < len(rows):
                return products(rows[at], q, self.largest)
            if kind not in whole:
                whole[kind] = products(rows, q, self.largest)
            return whole[kind][at]

        def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            d = np.sqrt(np.maximum(base - 2.0 * scored("centres", self.centres, nodes), 0.0))
            radii = self.radii[nodes]
            return ((base - (d + radii) ** 2) / 2 - slack,
                    (base - np.maximum(d - radii, 0.0) ** 2) / 2 + slack)

        nodes = np.zeros(1, dtype=np.int64)
        low, high = bounds(nodes)
        at_once, opened = FIRST, 0
        while True:
            keep = wanted(low, high)
            nodes, low, high = nodes[keep], low[keep], high[keep]
            if not len(nodes):
                return opened
            if len(nodes) > at_once:
                cut = np.argpartition(-high, at_once)
                now, later = cut[:at_once], cut[at_once:]
            else:
                now, later = np.arange(len(nodes)), np.zeros(0, dtype=np.int64)
            some = nodes[now]
            opened += len(some)
            at_once *= 2
            leaves = _ranges(self.leaf_ends[some], self.leaf_ends[some + 1] - self.leaf_ends[some])
            if len(leaves):
                visit(self.order[leaves], scored("leaves", self.sorted, leaves))
            kids = _ranges(self.first_kid[some], self.n_kids[some])
            below, above = bounds(kids)
            nodes = np.append(nodes[later], kids)
            low, high = np.append(low[later], below), np.append(high[later], above)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Best:
    """The first ``k`` rows of a window of scores, by score and then by id."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)
        self.floor = low  # a row must score this much to be among the first k

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = (scores >= self.floor) & (scores <= self.high)
        if not good.any():
            return
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = max(self.low, int(self.scores[-1]))


def dealt(rows: DataFrame) -> tuple[DataFrame, list]:
    """The candidates with ``row``, ``cell`` and ``block``, written; and a summary of each cell.

    A summary is (cell, blocks, largest norm squared, covering radius, pivot).
    """
    width_of = F.coalesce(F.max(F.size("v")), F.lit(0))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    size, width = rows.agg(F.count(F.lit(1)), width_of).first()
    if not size:
        return rows.withColumns({"cell": F.lit(0), "block": F.lit(0)}), []
    k = min(PIVOTS, max(1, math.ceil(size / CELL)))
    found = rows.select("v", F.xxhash64("vec_id", "row").alias("h")).orderBy("h").limit(k).collect()
    pivots = np.unique(matrix([r["v"] for r in found], width), axis=0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.einsum("ij,ij->i", pivots, pivots)
        for batch in batches:
            x = matrix(batch.column(2).to_pylist(), width)
            norm = np.einsum("ij,ij->i", x, x)
            cell = (own - 2 * (x @ pivots.T)).argmin(axis=1)
            away = x - pivots[cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(norm),
                 pa.array(np.einsum("ij,ij->i", away, away))],
                names=["vec_id", "label", "v", "row", "cell", "norm", "away"])

    placed = staged(rows.mapInArrow(place, "vec_id long, label long, v array<double>, row long, cell int, "
                                           "norm double, away double"), "placed")
    sums = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most"))
    lift = F.col("most") - F.col("norm")
    own = F.array(*(F.lit(float(p @ p)) for p in pivots))
    pivot_lift = F.col("most") - F.element_at(own, F.col("cell") + 1)
    gap = (F.sqrt(F.greatest(lift, F.lit(0.0))) - F.sqrt(F.greatest(pivot_lift, F.lit(0.0))))
    found = placed.join(F.broadcast(sums), "cell").groupBy("cell").agg(  # at most PIVOTS rows
        F.first("n").alias("n"), F.first("most").alias("most"),
        F.max(F.col("away") + gap * gap).alias("far"))
    cells = [(r["cell"], math.ceil(r["n"] / BLOCK), r["most"], math.sqrt(r["far"]), pivots[r["cell"]])
             for r in found.collect()]
    blocks = F.create_map(*(F.lit(x) for c in cells for x in c[:2]))
    return placed.drop("norm", "away").withColumn("block", F.pmod(
        F.xxhash64("row"), F.element_at(blocks, F.col("cell"))).cast("int")), cells


def _visits(anchors: DataFrame, cells: list, home: bool | None) -> DataFrame:
    """``anchors`` (row, cell, v, low, high, ...) once per (at, slot) it must see: a cell and a block.

    ``home``: only the first block of its own cell; False: all others; None: all. Cells whose score
    bounds leave nothing between ``low`` and ``high`` are skipped.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(cells[0][4])
        pivots = np.asarray([c[4] for c in cells]).reshape(len(cells), width)
        most, radius = (np.asarray([c[i] for c in cells]) for i in (2, 3))
        lift = np.maximum(most - np.einsum("ij,ij->i", pivots, pivots), 0.0)
        for batch in batches:
            at, slot, take = [], [], []
            q = matrix(batch.column("v").to_pylist(), width)
            lows = batch.column("low").to_numpy(zero_copy_only=False)
            highs = batch.column("high").to_numpy(zero_copy_only=False)
            own = batch.column("cell").to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                away = pivots - q[i]
                d = np.sqrt(np.einsum("ij,ij->i", away, away) + lift)
                base = float(q[i] @ q[i]) + most
                slack = SLACK * base + 0.5
                top = (base - np.maximum(d - radius, 0.0) ** 2) / 2 + slack
                least = (base - (d + radius) ** 2) / 2 - slack
                for j, (cell, blocks, *_) in enumerate(cells):
                    mine = cell == own[i]
                    if not mine and (home or top[j] < lows[i] or least[j] > highs[i]):
                        continue
                    for b in range(blocks):
                        if home is None or home == (mine and b == 0):
                            at.append(cell)
                            slot.append(b)
                            take.append(i)
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(take, pa.int64())).columns, pa.array(at, pa.int32()),
                 pa.array(slot, pa.int32())], names=[*batch.schema.names, "at", "slot"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(work, f"{fields}, at int, slot int")


def _searched(visits: DataFrame, placed: DataFrame, chunks: int, search, schema: str) -> DataFrame:
    """Runs ``search(anchors, candidates, tree)`` for each block and chunk of anchors."""
    def work(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(rows):
            width = max(rows["v"].map(len).max(), queries["v"].map(len).max())
            tree = CoverTree(matrix(rows["v"].tolist(), width))
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            own = rows["row"].to_numpy()
            for anchor, q in zip(queries.itertuples(index=False), matrix(queries["v"].tolist(), width)):
                out.extend(search(anchor, q, tree, ids, labels, own))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    spread = placed.select(F.col("cell").alias("at"), F.col("block").alias("slot"), "vec_id", "label",
                           "v", "row", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    keyed = visits.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    keys = ["at", "slot", "chunk"]
    return keyed.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(work, schema)


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _positives_in(k: int):
    """The best rows of the anchor's label in a block."""
    def search(anchor, q, tree, ids, labels, own):
        best = Best(k, int(anchor.low), int(anchor.high))

        def visit(rows: np.ndarray, scores: np.ndarray) -> None:
            same = (labels[rows] == anchor.label) & (own[rows] != anchor.row)
            best.offer(scores[same], ids[rows[same]])

        tree.search(q, visit, lambda low, high: high >= best.floor)
        return [(anchor.row, int(i), int(s)) for i, s in zip(best.ids, best.scores)]

    return search


def _negatives_in(k: int):
    """The best rows of other labels in a block, for each window of the anchor."""
    def search(anchor, q, tree, ids, labels, own):
        windows = [Best(k, int(a), int(b)) for a, b in zip(anchor.lows, anchor.highs)]

        def visit(rows: np.ndarray, scores: np.ndarray) -> None:
            other = labels[rows] != anchor.label
            other &= scores >= min(w.floor for w in windows)
            scores, found = scores[other], ids[rows[other]]
            for w in windows if len(scores) else ():
                w.offer(scores, found)

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            out = np.zeros(len(low), dtype=bool)
            for w in windows:
                out |= (high >= w.floor) & (low <= w.high)
            return out

        tree.search(q, visit, wanted)
        return [(anchor.row, int(n), int(i), int(s)) for n, w in zip(anchor.numbers, windows)
                for i, s in zip(w.ids, w.scores)]

    return search


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10,
         low_pct: int = 30, high_pct: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are :func:`candidates`; ``anchor`` says which of them are anchors. A negative has another
    label and a score from ``low_pct`` to ``high_pct`` percent of the positive's.
    """
    placed, cells = dealt(rows)
    if not cells:
        return rows.sparkSession.createDataFrame([], (
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
            "negative_score long"))
    lowest, highest = F.lit(-_LONG - 1), F.lit(_LONG)
    anchors = staged(placed.filter(anchor).select("row", "vec_id", "label", "cell", "v"), "anchors")
    chunks = max(1, math.ceil(anchors.count() / ANCHORS))

    def search(queries: DataFrame, home: bool | None, k: int) -> DataFrame:
        return _searched(_visits(queries, cells, home), placed, chunks, _positives_in(k),
                         "row long, id long, score long")

    open_ = anchors.withColumns({"low": lowest, "high": highest})
    first = staged(search(open_, True, positives), "positives")
    reached = first.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")) \
        .filter(F.col("n") >= positives).select("row", "low")
    known = anchors.join(reached, "row", "left").withColumns({
        "low": F.coalesce("low", lowest), "high": highest})
    more = search(staged(known, "anchors"), False, positives)
    best = staged(_ranked(first.unionByName(more), ["row"], positives)
                  .select("row", F.col("rank").alias("number"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score")), "positives")
    # low_pct * p <= 100 * s <= high_pct * p in whole numbers, without a product beyond a long.
    exact = F.col("positive_score").cast("decimal(38,0)")
    windowed = best.withColumns({
        "low": F.ceil(exact * low_pct / 100).cast("long"),
        "high": F.floor(exact * high_pct / 100).cast("long")}).filter("low <= high")
    of_anchor = windowed.groupBy("row").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.sort_array(F.collect_list(F.struct("number", "low", "high"))).alias("w")).select(
        "row", "low", "high", F.col("w.number").alias("numbers"), F.col("w.low").alias("lows"),
        F.col("w.high").alias("highs"))
    asked = staged(anchors.join(of_anchor, "row"), "windows")
    found = _searched(_visits(asked, cells, None), placed, chunks, _negatives_in(negatives),
                      "row long, number int, id long, score long")
    ranked = _ranked(staged(found, "negatives"), ["row", "number"], negatives)
    return ranked.join(best, ["row", "number"]).join(
        anchors.select("row", F.col("vec_id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """The negatives of every row whose id is divisible by 100; labels of ids divisible by 7 are
    moved to the next of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return mine(candidates(vectors, id_col, label_col, vector_col, moved), F.col("vec_id") % 100 == 0)
