"""Exact byte-pair encoding by backtracking, and decoding by an offset table.

Encoding: an Aho-Corasick automaton over the vocabulary gives every token match of a word. From
left to right the longest match is taken that is compatible with the token before it; where none
is left, the encoder steps back one token and takes its next shorter prefix. A position that once
led nowhere is not tried again, so the work is linear in the word. A sequence in which each pair of
neighbours is compatible is the one that merging by rank gives.

Decoding: token bytes lie in one block; a table of offsets turns ids into one gather of bytes.

Defined results: NULL text is the empty text and gives no ids; whole texts of any length are
encoded; added tokens in a text become their ids, as in the library; one row per row.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lagwise.llm.common import id_type, pick, slices
from lagwise.llm.tokens import SpacedChunks, held, packed_ids, read_spec

#: Fixed value: the published word pattern of this kind of vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, ranked merges, and for each token the merge that made it."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = 1 + max([*ids.values(), *self.added.values()])
        self.tokens = [b""] * size
        for text, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in text)
        for text, i in self.added.items():
            self.tokens[i] = text.encode()
        self.merges: dict[tuple[int, int], int] = {}  # pair -> rank
        made: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = ids[left], ids[right]
            self.merges[a, b] = rank
            made.setdefault(ids[left + right], (rank, a, b))
        self.made = made
        self.single = [0] * 256
        for text, i in ids.items():
            if len(text) == 1:
                self.single[letters[text]] = i
        self._result = {(a, b): t for t, (_, a, b) in made.items()}
        self.reachable = [i for i in ids.values() if i in made and self.by_rank(self.tokens[i]) == [i]]
        self.reachable += self.single

    def by_rank(self, word: bytes) -> list[int]:
        """The definition: merge the leftmost pair of lowest rank until there is none."""
        out = [self.single[b] for b in word]
        while len(out) > 1:
            rank, at = min((self.merges.get((out[i], out[i + 1]), _NEVER), i)
                           for i in range(len(out) - 1))
            if rank == _NEVER:
                break
            out[at:at + 2] = [self._result[out[at], out[at + 1]]]
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        self.length = [len(t) for t in vocabulary.tokens]
        for i in vocabulary.reachable:
            self.automaton.add_word(vocabulary.tokens[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self.values = SpacedChunks(self._whole, _joined)

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The tokens that lie at one end of ``token`` while it is merged, oldest first, each with
        the rank at which it becomes part of the next."""
        known = self._edges[right]
        if token not in known:
            steps, at, until = [], token, _NEVER
            while True:
                steps.append((at, until))
                if at not in self.v.made:
                    break
                until, a, b = self.v.made[at]
                at = b if right else a
            known[token] = steps[::-1]
        return known[token]

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging a's and b's bytes together never joins across their border.

        Ranks rise while a word is merged, so at each rank one token lies left of the border and
        one right of it; a merge of these two happens if its rank comes before both are taken up
        (at equal rank the left one goes first).
        """
        left, right = self._edge(a, True), self._edge(b, False)
        i = j = 0
        merges = self.v.merges
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = merges.get((x, y))
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if x_until == y_until == _NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _pair(self, a: int, b: int) -> bool:
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) > 1 << 19:
                self.compatible.clear()
            known = self.compatible[a, b] = self._fits(a, b)
        return known

    def word(self, word: bytes) -> list[int]:
        starts: list[list[int]] = [[] for _ in word]
        length = self.length
        for end, token in self.automaton.iter(word.decode("latin-1")):
            starts[end + 1 - length[token]].append(token)  # ends rise: the longest comes last
        out: list[int] = []
        tried: list[int] = []  # matches left to try at the start of each token of out
        dead = bytearray(len(word) + 1)
        at, left = 0, len(starts[0])
        while at < len(word):
            here = starts[at]
            while left:
                token = here[left - 1]
                left -= 1
                if not dead[at + length[token]] and (not out or self._pair(out[-1], token)):
                    out.append(token)
                    tried.append(left)
                    at += length[token]
                    left = len(starts[at]) if at < len(word) else 0
                    break
            else:
                dead[at] = 1
                at -= length[out.pop()]
                left = tried.pop()
        return out

    def _whole(self, chunk: str) -> tuple[int, str, bytes]:
        ids = [i for w in WORDS.findall(chunk) for i in self.word(w.encode())]
        return len(ids), ",".join(map(str, ids)), packed_ids(ids)

    def text(self, text: str) -> list[tuple[int, str, bytes]]:
        """(number, decimal ids, 32-bit ids) of each chunk in turn."""
        if not any(t in text for t in self.v.added):
            return self.values(text)
        out = []
        for part in re.split("(" + "|".join(map(re.escape, self.v.added)) + ")", text):
            if part in self.v.added:
                i = self.v.added[part]
                out.append((1, str(i), packed_ids([i])))
            else:
                out += self.values(part)
        return out


def _joined(values: list[tuple[int, str, bytes]]) -> tuple[int, str, bytes]:
    sizes, spelled, raw = zip(*values)
    return sum(sizes), ",".join(spelled), b"".join(raw)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.block = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, vocabulary.tokens)])

    def __call__(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become the replacement character."""
        begin = self.offsets[ids]
        sizes = self.offsets[ids + 1] - begin
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.block[np.arange(total) + np.repeat(begin - (ends - sizes), sizes)].tobytes()
        return raw.decode("utf-8", errors="replace").encode()


def coders(spec: str) -> tuple[Encoder, Decoder]:
    """One pair per worker process, kept between tasks."""
    def make() -> tuple[Encoder, Decoder]:
        vocabulary = Vocabulary(spec)
        return Encoder(vocabulary), Decoder(vocabulary)

    return held(("coders", hash(spec)), make)


def roundtrip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode every text, then decode its ids."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = coders(spec.value)
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                parts = encode.text(text)
                ids = np.frombuffer(b"".join([p[2] for p in parts]), dtype="<u4").astype(np.int64)
                rows.append((
                    len(ids),
                    hashlib.sha256(",".join([p[1] for p in parts]).encode()).hexdigest(),
                    hashlib.sha256(decode(ids)).hexdigest()))
            n, digests, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = pick(docs, id_col, text_col)
    return rows.mapInArrow(work, f"doc_id {id_type(rows)}, n_tokens long, ids_sha256 string, "
                                 "decoded_sha256 string")


def tokens_of(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: the ids themselves."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = coders(spec.value)
        for batch in slices(batches):
            ids = [np.frombuffer(b"".join([p[2] for p in encode.text(t)]), dtype="<i4")
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = pick(docs, id_col, text_col)
    return rows.mapInArrow(work, f"doc_id {id_type(rows)}, ids array<int>")


def texts_of(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decode = coders(spec.value)
        for batch in slices(batches):
            texts = [decode(np.asarray(ids or [], dtype=np.int64)).decode()
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(work, f"doc_id {id_type(rows)}, text string")
