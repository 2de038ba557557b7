"""Token-id files in a static range asymmetric numeral system.

A corpus is a folder of blocks. All blocks share one frequency table, and each can be decoded
alone: whole documents in ascending id order, coded by interleaved lanes (step t codes ids
t * LANES to t * LANES + LANES - 1, one per lane), with the lanes' states at every ``GAP`` steps as
checkpoints from which decoding can start, and a checksum of the ids. The blocks are binary values
of a Parquet folder, so any store that Spark can write holds them and a lost task leaves none.

Block layout, little-endian: magic, then unsigned 32-bit: documents, ids, words, checkpoints, CRC of
the ids, CRC of all that follows; then 64-bit document ids, 32-bit document lengths, per checkpoint
the 32-bit place in the words and one 64-bit state per lane, then the 32-bit words.

Defined results: NULL and empty text is the end id alone; a document of any length lies in one
block; ties and repeated rows are written one after the other; an empty table gives an empty
folder; a NULL document id is refused. A damaged block raises.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagwise.llm.common import in_steps, pick, slices
from lagwise.llm.tokens import LETTERS, ROWS, encoder, read_spec, vocabulary_size
from lagwise.sources.layers import fresh_path, staged

MAGIC, HEADER = b"LRA1", struct.Struct("<4s6I")
LANES, GAP = 1024, 128
SCALE = 20  # frequencies add up to 2**SCALE
LOW = np.uint64(1 << 31)
BLOCK_IDS = 1 << 18


class Table:
    """Frequencies of the ids, scaled to 2**SCALE; an id that was counted keeps at least one."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, dtype=np.float64)
        total = 1 << SCALE
        seen = counts > 0
        if seen.sum() > total:
            raise ValueError(f"over {total} distinct ids")
        scaled = np.zeros(len(counts), dtype=np.int64)
        if seen.any():
            room = total - int(seen.sum())
            scaled[seen] = 1 + np.floor(counts[seen] / counts.sum() * room).astype(np.int64)
            scaled[int(np.argmax(scaled))] += total - int(scaled.sum())
        self.frequency = scaled.astype(np.uint64)
        self.start = (np.cumsum(scaled) - scaled).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)


def encode_ids(ids: np.ndarray, table: Table) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """(checkpoints, words): from the last step to the first, each lane takes one id per step."""
    states = np.full(LANES, LOW, dtype=np.uint64)
    steps = -(-len(ids) // LANES)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    ids = ids.astype(np.intp)
    frequencies, starts = table.frequency.take(ids), table.start.take(ids)
    limits = frequencies << np.uint64(31 - SCALE + 32)
    turns = np.uint64(1 << SCALE) - frequencies  # what a whole turn adds beyond the frequency
    for step in range(steps - 1, -1, -1):
        here = slice(step * LANES, (step + 1) * LANES)
        frequency = frequencies[here]
        x = states[:len(frequency)]
        full = (x >= limits[here]).nonzero()[0]
        if len(full):
            high = x.take(full)
            words.append(high.astype(np.uint32))
            written += len(high)
            x[full] = high >> np.uint64(32)
        x += x // frequency * turns[here]
        x += starts[here]
        if step % GAP == 0:
            marks.append((written, states.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, dtype=np.uint32)
    # Places count from the front of the stream, where the decoder starts.
    return [(written - place, s) for place, s in marks[::-1]], stream


def decode_ids(n: int, place: int, states: np.ndarray, words: np.ndarray, table: Table,
               first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of steps ``first`` (where ``place`` and ``states`` hold) to ``last``."""
    steps = -(-n // LANES)
    last = steps if last is None else min(last, steps)
    out = []
    states = states.copy()
    mask = np.uint64((1 << SCALE) - 1)
    for step in range(first, last):
        x = states[:min(LANES, n - step * LANES)]
        slot = x & mask
        symbol = table.symbol.take(slot.view(np.int64))
        out.append(symbol)
        at = symbol.astype(np.intp)
        slot -= table.start.take(at)
        x >>= np.uint64(SCALE)
        x *= table.frequency.take(at)
        x += slot
        low = (x < LOW).nonzero()[0]
        if len(low):
            x[low] = x.take(low) << np.uint64(32) | words[place:place + len(low)]
            place += len(low)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


def write_block(doc_ids: list[int], documents: list[np.ndarray], table: Table) -> bytes:
    ids = np.concatenate(documents).astype("<u4")
    marks, words = encode_ids(ids, table)
    body = b"".join([
        np.asarray(doc_ids, dtype="<i8").tobytes(),
        np.asarray([len(d) for d in documents], dtype="<u4").tobytes(),
        *(struct.pack("<I", place) + s.astype("<u8").tobytes() for place, s in marks),
        words.astype("<u4").tobytes()])
    return HEADER.pack(MAGIC, len(documents), len(ids), len(words), len(marks),
                       zlib.crc32(ids.tobytes()), zlib.crc32(body)) + body


class Block:
    """A parsed block; ``ids(k)`` decodes from checkpoint k to the next, ``all_ids()`` everything."""

    def __init__(self, raw: bytes):
        magic, docs, self.n, words, marks, self.ids_crc, body_crc = HEADER.unpack_from(raw)
        if magic != MAGIC or zlib.crc32(raw[HEADER.size:]) != body_crc:
            raise ValueError("damaged block")
        at = HEADER.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        at += 8 * docs
        self.lengths = np.frombuffer(raw, "<u4", docs, at)
        at += 4 * docs
        self.marks = []
        for _ in range(marks):
            place, = struct.unpack_from("<I", raw, at)
            self.marks.append((place, np.frombuffer(raw, "<u8", LANES, at + 4)))
            at += 4 + 8 * LANES
        self.words = np.frombuffer(raw, "<u4", words, at).astype(np.uint64)

    def ids(self, mark: int, table: Table) -> np.ndarray:
        place, states = self.marks[mark]
        return decode_ids(self.n, place, states, self.words, table, mark * GAP, (mark + 1) * GAP)

    def all_ids(self, table: Table) -> np.ndarray:
        ids = np.concatenate([self.ids(k, table) for k in range(len(self.marks))]).astype("<u4")
        if zlib.crc32(ids.tobytes()) != self.ids_crc:
            raise ValueError("damaged block")
        return ids


def _counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs; what reaches the driver is one row per id of the vocabulary."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts = np.frombuffer(raw, "<i8")
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])],
                                                 names=["token", "n"])

    rows = encoded.filter(F.col("counts").isNotNull()).select("counts").mapInArrow(
        unpack, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r["token"] for r in rows), default=0), dtype=np.int64)
    for r in rows:
        counts[r["token"]] = r["n"]
    return counts


def write_corpus(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode, order by document id and write the blocks; returns the folder.

    The ids are staged once; then rows are dealt by ranges of the document id and sorted in each
    range. ``table`` beside ``blocks`` holds the frequencies.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    path = path or fresh_path(spark, "token-ids")
    # What is staged and shuffled takes two bytes per id if the vocabulary allows.
    width = "<u2" if max(end_id, vocabulary_size(spec.value) - 1) < 1 << 16 else "<u4"

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of each text, and in a last row how often this task has met each id."""
        encode, total = encoder(spec.value), np.zeros(0, dtype=np.int64)
        names = ["doc_id", "ids", "counts"]
        for batch in slices(batches, ROWS):
            for part in in_steps(batch, LETTERS):
                found, ends = encode.flat(part.column(1))
                ends += np.arange(1, len(ends) + 1)  # with the end ids
                ids, own = np.full(len(found) + len(ends), end_id, dtype=width), np.ones(len(found) + len(ends), dtype=bool)
                own[ends - 1] = False
                ids[own] = found
                more = np.bincount(ids, minlength=len(total))
                more[:len(total)] += total
                total = more
                at = np.append(0, ends * ids.itemsize).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.Array.from_buffers(
                        pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(ids)]),
                     pa.nulls(len(ends), pa.binary())], names=names)
        if len(total):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    rows = pick(docs, id_col, text_col)
    encoded = staged(rows.mapInArrow(tokenise, "doc_id long, ids binary, counts binary"), "ids")
    counts = _counts(encoded)
    spark.createDataFrame([(counts.tolist(),)], "counts array<long>").write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(counts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = Table(shared.value), TaskContext.get().partitionId()
        names: list[int] = []
        held: list[np.ndarray] = []
        first = size = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()),
                 pa.array([write_block(names, held, table)], pa.binary())],
                names=["part", "first", "n_ids", "block"])

        for batch in slices(batches):
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if doc_id is None:
                    raise ValueError("a document without an id has no place in the order")
                names.append(doc_id)
                held.append(np.frombuffer(raw, width))
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    first, size, names, held = first + size, 0, [], []
        if held:
            yield block()

    encoded = encoded.filter(F.col("counts").isNull()).select("doc_id", "ids")
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(write, "part long, first long, n_ids long, block binary").write.option(
        "compression", "none").parquet(f"{path}/blocks")
    return path


def read_corpus(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the folder.

    The place of a range in the corpus comes from one total per range: a table of as many rows as
    the write had partitions.
    """
    counts = np.asarray(spark.read.parquet(f"{path}/table").first()["counts"], dtype=np.int64)
    shared = spark.sparkContext.broadcast(counts)
    blocks = spark.read.parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = blocks.join(parts, "part").select((F.col("before") + F.col("first")).alias("first"),
                                               "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in slices(batches, 1):
            for first, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Block(raw)
                ids = found.all_ids(table)
                ends = np.cumsum(found.lengths, dtype=np.int64)
                texts = [ids[e - n:e].tobytes() for e, n in zip(ends, found.lengths.astype(np.int64))]
                arrays = [pa.array(found.doc_ids, pa.int64()),
                          pa.array(first + ends - found.lengths, pa.int64()),
                          pa.array(found.lengths.astype(np.int64), pa.int64()),
                          pa.array([zlib.crc32(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.array(texts, pa.binary())] * with_ids,
                    names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return placed.mapInArrow(read, schema)
