"""Packing of token ids into windows by Karmarkar-Karp multiway differencing.

Each task streams its documents. Whole windows are cut off long documents; what remains is packed
block by block: every remainder starts as a partition of its own, and the two partitions with the
largest imbalance are merged, the fullest window of one with the emptiest of the other, until one
partition of near-equal windows is left. If its fullest window is over capacity, the number of
windows rises and the block is packed again. Documents may be cut freely, so the room that is left
in the windows is then filled from the emptiest ones; what these still hold goes on to the next
block. The last leftover of a task becomes sequences whose lengths are powers of two, which need no
padding. Nothing is shuffled, and a task holds one block.

Defined results: NULL and empty text is the end id alone; a text of any length is cut; rows equal
in all columns are packed one by one; an empty table gives no pieces. A sequence id is the
task's number and a counter: unique, not dense.
"""
from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lagwise.llm.common import id_type, in_steps, pick, slices
from lagwise.llm.tokens import LETTERS, ROWS, encoder, read_spec

#: Windows of one block of remainders.
BLOCK_WINDOWS = 32


class Piece(NamedTuple):
    doc: int  # place in the task's list of documents
    start: int
    ids: np.ndarray


def _merged(a: tuple, b: tuple, windows: int) -> tuple:
    """Two partial partitions as one: the fullest windows of one join the emptiest of the other."""
    pad = [(0, ())] * windows
    left = (a + tuple(pad))[:windows]
    right = (b + tuple(pad))[:windows][::-1]
    return tuple(sorted(((x + y, (m, n)) for (x, m), (y, n) in zip(left, right)),
                        key=lambda w: -w[0]))


def _members(tree) -> list[int]:
    found, open_ = [], [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, int):
            found.append(node)
        else:
            open_.extend(node)
    return found


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Places of ``sizes`` in each of ``windows`` near-equal windows, the fullest first."""
    heap = [(-size, i, ((size, i),)) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = _merged(a, b, windows)
        low = both[-1][0] if len(both) == windows else 0
        heapq.heappush(heap, (low - both[0][0], tie, both))
        tie += 1
    return [_members(tree) for _, tree in heap[0][2]] if heap else []


def windows_for(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing into the fewest windows, counted up from the least possible, that all hold."""
    large = sorted((s for s in sizes if 2 * s > capacity), reverse=True)
    count = max(1, math.ceil(sum(sizes) / capacity), len(large))
    while True:
        out = differencing(sizes, count)
        if not out or max(sum(sizes[i] for i in w) for w in out) <= capacity:
            return out
        count += 1


def _cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    return (Piece(piece.doc, piece.start, piece.ids[:n]),
            Piece(piece.doc, piece.start + n, piece.ids[n:]))


def filled(windows: list[list[Piece]], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces left over (fewer ids than one window holds)."""
    windows = sorted(windows, key=lambda w: -sum(len(p.ids) for p in w))
    full = []
    while windows:
        window = windows.pop(0)
        room = capacity - sum(len(p.ids) for p in window)
        while room and windows:
            donor = windows[-1]
            piece = donor.pop()
            if len(piece.ids) > room:
                piece, rest = _cut(piece, room)
                donor.append(rest)
            window.append(piece)
            room -= len(piece.ids)
            if not donor:
                windows.pop()
        if room:
            return full, window
        full.append(window)
    return full, []


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces as sequences whose lengths are falling powers of two."""
    left, out = sum(len(p.ids) for p in pieces), []
    pieces = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        window = []
        while room:
            piece = pieces.pop(0)
            if len(piece.ids) > room:
                piece, rest = _cut(piece, room)
                pieces.insert(0, rest)
            window.append(piece)
            room -= len(piece.ids)
        out.append(window)
    return out


def sequences(documents: Iterable[np.ndarray], capacity: int) -> Iterator[list[Piece]]:
    """The packed sequences of one task; ``doc`` of a piece counts the documents that came."""
    held: list[Piece] = []
    total = 0
    for doc, ids in enumerate(documents):
        whole = len(ids) // capacity * capacity
        for at in range(0, whole, capacity):
            yield [Piece(doc, at, ids[at:at + capacity])]
        if whole < len(ids):
            held.append(Piece(doc, whole, ids[whole:]))
            total += len(ids) - whole
        if total >= BLOCK_WINDOWS * capacity:
            full, held = _block(held, capacity)
            yield from full
            total = sum(len(p.ids) for p in held)
    full, held = _block(held, capacity)
    yield from full
    yield from powers_of_two(held)


def _block(held: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    packed = windows_for([len(p.ids) for p in held], capacity)
    return filled([[held[i] for i in w] for w in packed if w], capacity)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    ``with_ids`` adds the ids themselves, as little-endian 32-bit integers.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    rows = pick(docs, id_col, text_col)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = rows.schema["doc_id"].dataType
    end = np.asarray([end_id], dtype="<u4")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec.value)
        about: dict[int, tuple] = {}  # of documents with pieces still to come

        def documents() -> Iterator[np.ndarray]:
            n = 0
            for batch in slices(batches, ROWS):
                for part in in_steps(batch, LETTERS):
                    for doc_id, ids in zip(part.column(0).to_pylist(), encode.arrays(part.column(1))):
                        ids = np.concatenate([ids, end])
                        about[n] = [doc_id, len(ids), len(ids)]
                        n += 1
                        yield ids

        def rows_of(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found))
            types = [ids_type, *[pa.int64()] * 6] + [pa.binary()] * with_ids
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=names + ["ids"] * with_ids)

        sequence = (TaskContext.get().partitionId() << 40) - 1
        out: list[tuple] = []
        for window in sequences(documents(), capacity):
            sequence += 1
            offset = 0
            for piece in window:
                of = about[piece.doc]
                raw = piece.ids.tobytes()
                out.append((of[0], piece.start, len(piece.ids), zlib.crc32(raw), of[1], sequence,
                            offset) + ((raw,) if with_ids else ()))
                offset += len(piece.ids)
                of[2] -= len(piece.ids)
                if not of[2]:
                    del about[piece.doc]
            if len(out) >= 4096:
                yield rows_of(out)
                out = []
        if out:
            yield rows_of(out)

    from pyspark.sql.pandas.types import to_arrow_type
    ids_type = to_arrow_type(kind)
    schema = f"doc_id {id_type(rows)}, " + ", ".join(f"{n} long" for n in names[1:])
    return rows.mapInArrow(work, schema + ", ids binary" * with_ids)
