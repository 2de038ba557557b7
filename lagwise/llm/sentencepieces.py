"""Exact SentencePiece encoding through a table of distinct chunks, and decoding by offsets.

A text becomes marks and letters: each space is a mark, and one mark is put before the text. If no
piece holds a mark after another character (the vocabulary is checked), no piece crosses from a
letter to the next mark, and the chunks between these places can be segmented on their own: merges
never reach over them. The same holds at line ends, if no piece of several characters has one.

Texts come in slices. The distinct chunks of a slice that the table of the task does not hold yet are
segmented in one call of the library, once each, and enter the table; then the ids of all chunks are
joined back by position. The table lives in the Python worker, keeps what was seen again through two
generations, and has a fixed size; chunks beyond ``LONGEST`` characters are segmented where they are.
A table over all tasks would shuffle each rare word of each text (1.0 million of 1.8 million distinct
words of the 0.1 GB test table occur once) to save a few microseconds for each; this shuffles nothing.

Decoding puts the bytes of the pieces one after another by a table of offsets. What is not valid
UTF-8, or holds an id that is no plain piece, goes to the library.

Defined results: NULL and empty texts are the begin and end ids alone and decode to the empty text.
Rows with equal ids or texts are encoded one by one. Texts of any length are read whole. An empty table
gives an empty table. Other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lagwise.llm.common import id_type, pick, slices
from lagwise.llm.tokens import held

MARK = "▁"
#: Chunks of a generation of the table, and the longest that it keeps.
REMEMBERED, LONGEST = 1 << 17, 64
_MARKED = re.compile(f"{MARK}*[^{MARK}]*")


class Pieces:
    """A SentencePiece model; ``model`` is the content of its file."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_proto=model)
        get = self.library
        size = get.get_piece_size()
        names = get.id_to_piece(list(range(size)))
        plain = [not (get.is_control(i) or get.is_unknown(i) or get.is_unused(i)) for i in range(size)]
        byte = [get.is_byte(i) for i in range(size)]
        normal = [p for p, ok, b in zip(names, plain, byte) if ok and not b]
        #: Whether texts can be cut before marks: what normalisation leaves of a text is known, and
        #: no piece has a mark after something else.
        self.mark = get.piece_to_id(MARK)
        self.cuts = (self._only_marks() and not get.is_unknown(self.mark)
                     and not any(MARK in p.lstrip(MARK) for p in normal))
        self.cuts_lines = self.cuts and not any("\n" in p and p != "\n" for p in normal)
        self.begin, self.end = get.bos_id(), get.eos_id()
        shown = [bytes([int(p[3:5], 16)]) if b else p.replace(MARK, " ").encode() if ok else b""
                 for p, ok, b in zip(names, plain, byte)]
        lengths = np.asarray([len(s) for s in shown], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        self.shown = np.asarray(plain)
        self.silent = {i for i in (self.begin, self.end) if i >= 0}
        self.shown[list(self.silent)] = True  # as nothing
        self.marked = np.asarray([p.startswith(MARK) for p in names])
        #: chunk -> its ids as unsigned 32-bit integers
        self.table: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _only_marks(self) -> bool:
        """Whether the library turns a text into marks and letters in the way that is relied on."""
        return all(self.library.normalize(t) == MARK + t.replace(" ", MARK) if t else True
                   for t in ("a", " a", "a  b ", "AÉ ﬁ ①", "a\nb", "é\t"))

    def chunks(self, text: str) -> list[str]:
        """The text as chunks, one mark at the start of each taken off; a chunk after a line end
        keeps the line end in the mark's place."""
        if not text:
            return []
        if not self.cuts:
            return [text]
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            marked = _MARKED.findall(MARK + text.replace(" ", MARK))
            return self._lines([c[1:].replace(MARK, " ") for c in marked if c])
        return self._lines(text.split(" "))

    def _lines(self, parts: list[str]) -> list[str]:
        if not self.cuts_lines:
            return parts
        out = []
        for part in parts:
            if "\n" in part:
                first, *more = part.split("\n")
                out.append(first)
                out.extend("\n" + m for m in more)
            else:
                out.append(part)
        return out

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks by one call; the mark that the library adds before a line end is cut off.

        A chunk without letters is the mark alone; a space stands in for it in the call."""
        found = self.library.encode([c or " " for c in chunks], num_threads=1)
        return [_packed([self.mark] if not chunk else
                        ids[1:] if chunk[0] == "\n" and self.cuts_lines else ids)
                for chunk, ids in zip(chunks, found)]

    def encode(self, texts: list[str], begin: bool = True, end: bool = True) -> list[np.ndarray]:
        """Ids of whole texts."""
        cut = [self.chunks(t) for t in texts]
        table, old, here = self.table, self.old, {}
        wanted = {c for chunks in cut for c in chunks if c not in table}
        for c in [c for c in wanted if c in old]:
            table[c] = old[c]
            wanted.discard(c)
        new = sorted(wanted)
        for c, ids in zip(new, self._segment(new) if new else []):
            (table if len(c) <= LONGEST else here)[c] = ids
        first = _packed([self.begin] if begin else [])
        last = _packed([self.end] if end else [])
        get = (lambda c: table[c] if c in table else here[c]) if here else table.__getitem__
        out = [np.frombuffer(b"".join([first, *map(get, chunks), last]), dtype=np.uint32)
               for chunks in cut]
        if len(table) >= REMEMBERED:
            self.old, self.table = table, {}
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text of ids in UTF-8, as the library decodes them."""
        if not len(ids):
            return b""
        if not self.cuts or ids.max() >= len(self.lengths) or not self.shown[ids].all():
            return self._decoded_by_library(ids)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        shown = self.bytes[at].tobytes()
        try:
            shown.decode()
        except UnicodeDecodeError:
            return self._decoded_by_library(ids)
        first = next((i for i in ids[:2 + len(self.silent)].tolist() if i not in self.silent), None)
        return shown[1:] if first is not None and self.marked[first] else shown

    def _decoded_by_library(self, ids: np.ndarray) -> bytes:
        return self.library.decode(ids.tolist()).encode()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"={len(ids)}I", *ids)


def pieces(model: bytes) -> Pieces:
    """One model per worker process, kept between tasks."""
    return held(("pieces", hash(model)), lambda: Pieces(model))


def read_model(path: str) -> bytes:
    """The model file, read on the driver (under 1 MB) and sent to the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _in_steps(batch: pa.RecordBatch, most: int = 1 << 22) -> Iterable[pa.RecordBatch]:
    """A slice cut where its texts would hold more than ``most`` characters together."""
    lengths = pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False)
    start = 0
    ends = np.cumsum(lengths)
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           begin: bool = True, end: bool = True) -> DataFrame:
    """(doc_id, ids) of whole texts."""
    docs, model = pick(docs, id_col, text_col), read_model(model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = pieces(model)
        for batch in slices(batches):
            for part in _in_steps(batch):
                found = get.encode(part.column(1).to_pylist(), begin, end)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f.view(np.int32) for f in found], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])

    return docs.mapInArrow(work, f"doc_id {id_type(docs)}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); NULL ids give a NULL text."""
    rows, model = encoded.select("doc_id", "ids"), read_model(model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = pieces(model)
        for batch in slices(batches):
            texts = [None if ids is None else get.decode(np.asarray(ids, dtype=np.int64)).decode()
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return rows.mapInArrow(work, f"doc_id {id_type(rows)}, text string")


def roundtrip(docs: DataFrame, model_path: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, then decoded from its ids."""
    docs, model = pick(docs, id_col, text_col), read_model(model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = pieces(model)
        for batch in slices(batches):
            for part in _in_steps(batch):
                counts, of_ids, of_text = [], [], []
                for ids in get.encode(part.column(1).to_pylist()):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    of_text.append(hashlib.sha256(get.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(work, f"doc_id {id_type(docs)}, n_tokens long, ids_sha256 string, "
                                 "decoded_sha256 string")
