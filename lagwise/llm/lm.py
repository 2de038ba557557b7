"""Scores of texts under a backoff model of all words, pairs and triples that are repeated.

A pair or triple is kept if it occurs ``LEAST`` times in the training texts, whatever these weigh.
Words, pairs and triples live in written tables, of any size.

The model is a weighted backoff automaton. A state is the longest kept context: a pair, a word or
the root. An arc reads a token, adds its log probability and leads to the longest kept context that
ends there; a state without an arc for the token takes its failure arc to the next shorter context
and adds the backoff weight. All of it is one table, ``machine``, by the key of the n-gram: its count,
from which the arc that spells it follows, and its failure weight as a state. A text is traversed once
from left to right with the state carried along.

N-grams are counted in two passes. The first sends 4 bytes of each and leaves a filter of fixed size
with those that may be repeated; the second counts what the filter lets through. A full filter costs
a larger shuffle, never a result. Words are counted with the first look at pairs, pairs with the first
look at triples, so the texts are read three times. Counts, and what follows each context, meet in
ranges of the machine as blocks of sorted keys. The ``HOT`` most frequent rows of the machine are sent to every task,
and a filter rules out n-grams that are not in it. What a slice of texts asks beyond that goes to
ranges of the machine as blocks of sorted keys; the answers come back in the same order and meet the
texts of the slice before these are traversed. The number of ranges follows the number of tokens, so
a range fits in a task at any size. Texts are scored in rounds, dealt by a hash, so what is written and
shuffled for one round is gone before the next.

Words, pairs and triples are known by 64-bit hashes in the machine.

The probability of a token t in context h with kept continuations K(h), c(h) occurrences and the
discount D: (c(h t) - D) / c(h) if t is in K(h), else weight(h) * P(t | shorter h), with the weight
that makes it add up to one. At the root: (c(t) + 1) / (N + V + 1).

Defined results: NULL and empty texts are the end token alone. A NULL id counts as the empty text
in the fold. Rows with equal ids or texts are scored one by one. An empty table gives an empty
table. Whole texts of any length are read.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.llm.common import id_type, in_steps, pick, slices
from lagwise.sources.layers import Scope, scope, staged

#: Least count of a kept pair or triple.
LEAST = 2
#: Shares of all training tokens from which words are numbered and pairs broadcast in joins: at most
#: 1 / share of them, all others are joined. HOT: how many rows every task gets at most.
ARC_SHARE, GRAM_SHARE, HOT = 1 / 2**19, 1 / 2**18, 1 << 18
DISCOUNT = 0.5
END = b""
_SHIFT = 20
_BEGIN = (1 << _SHIFT) - 1  # context before the first token; no word has this number
_FLUSH = 200_000
_RANGE = 1 << 20  # tokens for each range of keys
_ROUNDS = 3  # in which texts are scored: what one writes and shuffles goes before the next
_FILTER_BITS = 28
#: Rows and characters whose n-grams are counted, or that are scored, at once; a longer text is alone.
_COUNTED, _SCORED = (4096, 1 << 22), (512, 1 << 20)
_HASH_OF_BEGIN, _HASH_OF_END = 0x5851F42D4C957F2D, xxhash.xxh64_intdigest(END)
_LONG = 64  # bytes of a word that are hashed eight at a time; longer words are hashed one by one
_AT_ONCE = 1 << 16  # words that are hashed at once: their arrays stay in the cache
_FIRST = np.asarray([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n of eight bytes


def tokens(text: str) -> list[bytes]:
    """Lower-case (A-Z) words between ASCII white space, then the end."""
    return [*text.encode().lower().split(), END]


def remainder(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def _texts(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[str]:
    for batch in slices(batches):
        yield from batch.column(at).to_pylist()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens; each task adds up what it reads before anything is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())],
                names=["word", "n"])

        found: Counter = Counter()
        for text in _texts(batches):
            found.update(tokens(text))
            if len(found) >= _FLUSH:
                yield rows()
                found = Counter()
        yield rows()

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Numbers of the frequent words, the most frequent first."""

    def __init__(self, counts: list[tuple[bytes, int]]):
        ordered = sorted(counts, key=lambda wc: (-wc[1], wc[0]))
        self.number = {w: i for i, (w, _) in enumerate(ordered)}
        self.counts = [n for _, n in ordered]
        ends = np.cumsum([0, *(len(w) for w, _ in ordered)], dtype=np.int64)
        raw = np.frombuffer(b"".join([w for w, _ in ordered]) + bytes(16), np.uint8)
        self.hashes = np.where(ends[1:] > ends[:-1], word_hashes(raw, ends[:-1], ends[1:]),
                               np.uint64(_HASH_OF_END))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words at places of ``raw``, which goes on for 8 bytes or more after the last."""
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    out = np.empty(len(starts), dtype=np.uint64)
    for first in range(0, len(starts), _AT_ONCE):
        at, x = starts[first:first + _AT_ONCE], out[first:first + _AT_ONCE]
        size = ends[first:first + _AT_ONCE] - at
        np.multiply(size.view(np.uint64), np.uint64(0xC2B2AE3D27D4EB4F), out=x)
        _stir(x, eights[at], size)
        open_ = np.flatnonzero((size > 8) & (size <= _LONG))
        for done in range(8, _LONG, 8):
            if not len(open_):
                break
            left = size.take(open_) - done
            more = x.take(open_)
            _stir(more, eights[at.take(open_) + done], left)
            x[open_] = more
            open_ = open_.compress(left > 8)
        for i in np.flatnonzero(size > _LONG).tolist():
            x[i] = xxhash.xxh64_intdigest(raw[at[i]:at[i] + size[i]].tobytes())
    return out


def _stir(x: np.ndarray, eight: np.ndarray, left: np.ndarray) -> None:
    """The first ``left`` bytes of ``eight`` go into the hashes ``x``; both are written over."""
    eight &= _FIRST.take(left, mode="clip")
    x ^= eight
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= np.right_shift(x, np.uint64(32), out=eight)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= np.right_shift(x, np.uint64(29), out=eight)


class Tokens:
    """The tokens of some texts one after another: their hashes with a begin before each text, and
    the text of each."""

    def __init__(self, texts: pa.StringArray):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.frombuffer(texts.buffers()[1] or bytes(4), np.int32)[texts.offset:][:len(texts) + 1]
        ends = ends.astype(np.int64) - ends[0] + np.arange(-1, len(texts))  # a space ends each text, too
        ends[0] = 0
        one = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), " ")
        data = np.frombuffer(one[0].as_buffer(), np.uint8)
        raw = np.zeros(len(data) + 16, dtype=np.uint8)
        low = raw[:len(data)]
        np.multiply((data - np.uint8(65)) < 26, np.uint8(32), out=low)
        low |= data
        in_word = np.zeros(len(data) + 2, dtype=bool)
        np.logical_and(data != 32, (data - np.uint8(9)) > 4, out=in_word[1:-1])
        edges = np.flatnonzero(in_word[1:] != in_word[:-1])
        begins, stops = edges[::2].copy(), edges[1::2].copy()
        self.lengths = np.diff(np.searchsorted(begins, ends)) + 1
        place = np.cumsum(self.lengths + 1)  # where the next text begins
        self.text = np.repeat(np.arange(len(texts)), self.lengths + 1)
        self.hashes = np.empty(len(self.text), dtype=np.uint64)
        inner = np.ones(len(self.text), dtype=bool)
        for at, value in ((place - self.lengths - 1, _HASH_OF_BEGIN), (place - 1, _HASH_OF_END)):
            self.hashes[at] = value
            inner[at] = False
        self.hashes[inner] = word_hashes(raw, begins, stops)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of neighbours, whether both are of one text, and whether the next pair is as well."""
        one = self.text[:-1] == self.text[1:]
        return _key(self.hashes[:-1], self.hashes[1:], 1), one, one[:-1] & one[1:]


def _key(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    x, y = a * np.uint64(0x9E3779B97F4A7C15), b * np.uint64(0xC2B2AE3D27D4EB4F)
    y += np.uint64(salt)
    x ^= y
    x ^= np.right_shift(x, np.uint64(31), out=y)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(29), out=y)
    return x


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _bits(size: int) -> int:
    """How many upper bits of a key name its range, for ``size`` tokens."""
    return min(_FILTER_BITS - 3, max(1, math.ceil(size / _RANGE).bit_length()))


def _runs(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The ranges that occur in sorted keys, and where the keys of each begin and end."""
    at = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, dtype=np.int64)
    return at[starts], list(zip(starts.tolist(), [*starts[1:].tolist(), len(at)]))


def _joined(blocks: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=kind), *(np.frombuffer(x, kind) for x in blocks.to_pylist())])


def _parts(batches: Iterator[pa.RecordBatch], most: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most[0]):
        yield from in_steps(batch, most[1], batch.num_columns - 1)  # the texts are the last column


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, an order of ``keys`` and where each distinct one begins in it."""
    order = np.argsort(keys)
    keys = keys.take(order)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys.take(starts), order, starts


def _blocks(kind: int, keys: np.ndarray, bits: int, **columns: np.ndarray) -> pa.RecordBatch:
    """The rows of sorted keys as one row for each range."""
    ranges, ends = _runs(keys, bits)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(ends), pa.int32()), pa.array(ranges),
         *(pa.array([columns[c][i:j].tobytes() for i, j in ends] if c in columns else [None] * len(ends),
                    pa.binary()) for c in "abn")], names=["kind", "range", "a", "b", "n"])


#: What is counted in blocks: words by their key, n-grams by those of their two parts, or the upper
#: ``bits`` + 32 bits of the keys of n-grams, to see which may be repeated. The blocks of a range make
#: rows and one block (sorted keys, counts) of the machine, or the bits of a filter in this range.
_OF_WORDS, _OF_GRAMS, _MAYBE, _BLOCK = 0, 1, 2, 3
_BLOCKS, _COUNTS = "kind int, range long, a binary, b binary, n binary", (
    "kind int, key long, a long, b long, n long, data binary, more binary")
#: Blocks of the machine: counts of sorted keys, or what the kept n-grams add to contexts.
_OF_MACHINE = "range long, keys binary, n binary, used binary, lower binary"


def _words_of(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    keys, n = np.unique(keys, return_counts=True)
    return _blocks(_OF_WORDS, keys, bits, a=keys, n=n.astype(np.int64))


def _maybe_of(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    keys, n = np.unique(keys, return_counts=True)
    keys = np.repeat(keys, np.minimum(n, LEAST))
    return _blocks(_MAYBE, keys, bits, a=(keys >> np.uint64(32 - bits)).astype(np.uint32))


def _grams_of(keys: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int) -> pa.RecordBatch:
    keys, order, starts = _distinct(keys)
    at = order.take(starts)
    n = np.diff(np.append(starts, len(order))).astype(np.int64)
    return _blocks(_OF_GRAMS, keys, bits, a=a.take(at), b=b.take(at), n=n)


def _segment(first: int, keys: np.ndarray, bits: int) -> bytes:
    """The bits of a filter in the range ``first``, in which all the keys are."""
    held = np.zeros(1 << _FILTER_BITS - bits, dtype=bool)
    held[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64) - (first << _FILTER_BITS - bits)] = True
    return np.packbits(held, bitorder="little").tobytes()


def _counted(texts: DataFrame, counts_of, bits: int, salt: int) -> DataFrame:
    """Rows of (kind, key, a, b, n), and (kind, key, bits) for ranges of what may be repeated, of the
    blocks that ``counts_of`` makes of the tokens of some texts. Of n-grams, those with at least
    ``LEAST`` occurrences; ``salt`` is that of their keys."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, _COUNTED):
            yield from counts_of(Tokens(part.column(0)))

    def rows(kind: int, keys: np.ndarray, data: bytes | None = None, more: bytes | None = None, **columns) -> pa.Table:
        return pa.table({"kind": pa.array([kind] * len(keys), pa.int32()), "key": _longs(keys), **{
            c: _longs(columns[c]) if c in columns else pa.nulls(len(keys), pa.int64()) for c in "abn"},
            **{name: pa.array([x] * len(keys), pa.binary()) for name, x in (("data", data), ("more", more))}})

    def added(blocks: pa.Table) -> pa.Table:
        kind, first = blocks["kind"][0].as_py(), blocks["range"][0].as_py()
        name = np.asarray([first], dtype=np.uint64)
        if kind == _MAYBE:
            short = np.sort(_joined(blocks["a"], "<u4"))
            last = short[LEAST - 1:]
            again = last[last == short[:len(last)]].astype(np.uint64)
            keys = name << np.uint64(64 - bits) | again << np.uint64(32 - bits)
            return rows(kind, name, _segment(first, keys, bits))
        a, n = _joined(blocks["a"], "<u8"), _joined(blocks["n"], "<i8")
        b = _joined(blocks["b"], "<u8") if kind == _OF_GRAMS else a
        keys, order, starts = _distinct(_key(a, b, salt) if kind == _OF_GRAMS else a)
        sums, at = np.add.reduceat(n.take(order), starts), order.take(starts)
        if kind == _OF_GRAMS:
            often = sums >= LEAST
            keys, sums, at = keys.compress(often), sums.compress(often), at.compress(often)
        parts = {"a": a.take(at), "b": b.take(at)} if kind == _OF_GRAMS else {}
        return pa.concat_tables([rows(kind, keys, n=sums, **parts),
                                 rows(_BLOCK, name, _planes(keys), _planes(sums))])

    return texts.mapInArrow(count, _BLOCKS).groupBy(
        "kind", "range").applyInArrow(added, _COUNTS)


class Filter:
    """Bits that travel compressed: every executor writes what is broadcast to its disk."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __getstate__(self) -> bytes:
        return pa.Codec("zstd").compress(self.bits, asbytes=True)

    def __setstate__(self, data: bytes) -> None:
        self.bits = np.frombuffer(pa.Codec("zstd").decompress(data, 1 << _FILTER_BITS - 3), dtype=np.uint8)


def _filter(segments: DataFrame, bits: int) -> Filter:
    """Bits of the keys' upper ``_FILTER_BITS`` bits, of (range, bits): of fixed size, whatever the table is."""
    found, size = segments.select("range", "bits").toArrow(), 1 << _FILTER_BITS - bits - 3
    out = np.zeros((1 << bits, size), dtype=np.uint8)
    for at, data in zip(found["range"].to_pylist(), found["bits"].to_pylist()):
        out[at] = np.frombuffer(data, dtype=np.uint8)
    return Filter(out.reshape(-1))


def _may_hold(kept: Filter, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - _FILTER_BITS)
    bit = place.astype(np.uint8) & np.uint8(7)
    place >>= np.uint64(3)
    return kept.bits.take(place.view(np.int64)) >> bit & 1 > 0


class Hot:
    """Rows of the machine by key in two tables of slots; of keys with the same slot, the most frequent
    stays, the others go to the second table or are left out. Only the rows travel."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, n: np.ndarray):
        self.rows = keys, values, n
        self._fill(keys, values, n)

    def __getstate__(self) -> tuple:
        return self.rows

    def __setstate__(self, rows: tuple) -> None:
        self._fill(*rows)

    def _fill(self, keys: np.ndarray, values: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(n, kind="stable")  # of equal slots, the last one written stays
        keys, values = keys[order], values[order]
        self.bits = max(4, int(len(keys)).bit_length() + 1)
        self.tables = []
        for turn in (0, 32):
            held, value = np.zeros(1 << self.bits, dtype=np.uint64), np.zeros((1 << self.bits, 2))
            slot = self._slot(keys, turn)
            held[slot], value[slot] = keys, values
            self.tables.append((turn, held, value))
            lost = held[slot] != keys
            keys, values = keys[lost], values[lost]

    def _slot(self, keys: np.ndarray, turn: int) -> np.ndarray:
        return (keys >> np.uint64(turn) & np.uint64((1 << self.bits) - 1)).view(np.int64)

    def look_up(self, keys: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        """Places of the keys that are not here; the rows of the others are put in ``values``. Key 0 is
        not used."""
        open_ = None  # all
        for turn, held, value in self.tables:
            some = keys if open_ is None else keys.take(open_)
            slot = self._slot(some, turn)
            hit = held.take(slot) == some
            places = np.flatnonzero(hit)
            if values is not None:
                _put(values, places if open_ is None else open_.take(places), value.take(slot.take(places), axis=0))
            open_ = np.flatnonzero(~hit) if open_ is None else open_.compress(~hit)
        return open_


def _put(rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
    """rows[places] = values, for rows of two numbers: as one of 16 bytes each, which numpy moves faster."""
    rows.view(np.complex128)[:, 0][places] = values.view(np.complex128)[:, 0]


class Wanted:
    """The words, pairs and triples of some texts with what the hot rows say about them, and ``keys``:
    sorted, those that the machine may hold beyond. Only a triple of two kept pairs is kept."""

    def __init__(self, found: Tokens, hot: Hot, kept: Filter, told: bool = True):
        pair, one, both = found.pairs()
        self.one, self.both = one, both
        one = one & _may_hold(kept, pair)
        both = both & one[:-1] & one[1:]
        of_pairs, of_triples = np.flatnonzero(one), np.flatnonzero(both)
        triple = _key(pair.take(of_triples), pair.take(of_triples + 1), 2)
        good = _may_hold(kept, triple)
        of_triples, triple = of_triples.compress(good), triple.compress(good)
        both[:] = False
        both[of_triples] = True
        self.grams, asked = [], []
        for size, places, keys in ((len(found.hashes), None, found.hashes),
                                   (len(pair), of_pairs, pair.take(of_pairs)),
                                   (len(both), of_triples, triple)):
            values = np.zeros((len(keys), 2)) if told else None
            open_ = hot.look_up(keys, values)
            if places is None:
                open_ = open_.compress(_may_hold(kept, keys.take(open_)))
            asked.append(keys.take(open_))
            self.grams.append((size, places, values, open_))
        keys = np.concatenate(asked)
        if told:
            self.keys, order, starts = _distinct(keys)
            self.at = np.empty(len(keys), dtype=np.int64)
            self.at[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        else:
            keys = np.sort(keys)
            self.keys = keys.compress(np.append(True, keys[1:] != keys[:-1])[:len(keys)])

    def rows(self, answers: np.ndarray) -> Iterator[np.ndarray]:
        """Rows of the words, pairs and triples; ``answers`` are those of ``keys``."""
        held = 0
        for size, places, values, open_ in self.grams:
            _put(values, open_, answers.take(self.at[held:held + len(open_)], axis=0))
            held += len(open_)
            if places is None:
                yield values
            else:
                out = np.zeros((size, 2))
                _put(out, places, values)
                yield out


def _planes(values: np.ndarray) -> bytes:
    """8-byte values as their first bytes, then their second ones, ...: sorted keys compress well so."""
    out, eights = np.empty((8, len(values)), dtype=np.uint8), values.view(np.uint8).reshape(-1, 8)
    for i in range(8):  # faster than to transpose
        out[i] = eights[:, i]
    return out.tobytes()


def _of_planes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    out = np.empty((planes.shape[1], 8), dtype=np.uint8)
    for i in range(8):
        out[:, i] = planes[i]
    return out.reshape(-1).view(kind)


def _of_blocks(blocks: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=kind), *(_of_planes(x, kind) for x in blocks.to_pylist())])


def traverse(root: np.ndarray, word_weight: np.ndarray, pair_arc: np.ndarray, pair_weight: np.ndarray,
             triple_arc: np.ndarray) -> np.ndarray:
    """What each position of some texts in a row adds to the log10 probability, read from left to right
    from the state of the begin before each text (whose position adds nothing of use).

    ``root[i]`` is what the root's arc for token i adds; ``pair_arc[i]`` the arc that token i + 1 takes
    from the word i, ``pair_weight[i]`` the failure weight of the state of these two, ``triple_arc[i]`` the
    arc of token i + 2 from that state. NaN: no such arc, so the failure arc is taken. Whichever arc token i
    takes, it leads to the state of the last two if ``pair_arc[i - 1]`` is there, else to that of the last
    one: so the state before each token is known, and all tokens take their arcs at once.
    """
    adds = np.zeros(len(root))
    if len(root) < 2:
        return adds
    has = ~np.isnan(pair_arc)
    adds[1:] = np.where(has, pair_arc, word_weight[:-1] + root[1:])
    in_pair = has[:-1]  # before token i + 2: the state is a pair
    adds[2:] += np.where(in_pair, pair_weight[:-1], 0.0)
    return np.where(np.append([False, False], in_pair & ~np.isnan(triple_arc)),
                    np.append([0.0, 0.0], triple_arc), adds)


def _attached(rows: DataFrame, key: str, table: DataFrame, hot) -> DataFrame:
    """``rows`` (written) with the columns of ``table`` (written; it has every key): keys with
    ``hot``, of which there are few, by a broadcast, so that no task gets all rows of one key."""
    own = rows.columns
    met = rows.join(F.broadcast(table.filter(hot).withColumn("hot", F.lit(True))), key, "left")
    return met.filter("hot").drop("hot").unionByName(
        met.filter(F.col("hot").isNull()).select(*own).join(table.filter(~hot), key))


class Automaton:
    """The model of a small corpus in memory: states are the root, words and kept pairs; a state
    without an arc for a token takes its failure arc to the next shorter context.

    ``arcs``: state << 20 | word -> (log10 probability, next state); ``fail``: state ->
    (log10 backoff weight, next shorter state). State 0 is the root."""

    def __init__(self, words: Words, total: int, distinct: int, pairs: dict[int, int],
                 triples: dict[int, int], texts: int):
        bottom = total + distinct + 1
        mask = (1 << _SHIFT) - 1
        root = [(n + 1) / bottom for n in words.counts]
        state_of_word = {w: 1 + w for w in range(len(words.counts))} | {_BEGIN: 1 + len(words.counts)}
        self.start = 1 + len(words.counts)
        ordered = sorted(pairs)
        state_of_pair = {p: self.start + 1 + i for i, p in enumerate(ordered)
                         if p & mask != words.number.get(END)}
        self.arcs = {w: (math.log10(p), state_of_word.get(w, 0)) for w, p in enumerate(root)}
        self.fail: dict[int, tuple[float, int]] = {}
        seen = {_BEGIN: max(1, texts)} | dict(enumerate(words.counts))
        follow: dict[int, list[tuple[int, int]]] = {}
        for pair, n in pairs.items():
            follow.setdefault(pair >> _SHIFT, []).append((pair & mask, n))
        of_pair: dict[int, float] = {}
        for context, state in state_of_word.items():
            kept = follow.get(context, [])
            for w, n in kept:
                p = of_pair[context << _SHIFT | w] = (n - DISCOUNT) / seen[context]
                self.arcs[state << _SHIFT | w] = (
                    math.log10(p), state_of_pair.get(context << _SHIFT | w, state_of_word.get(w, 0)))
            self._failure(state, 0, sum(n - DISCOUNT for _, n in kept) / seen[context],
                          sum(root[w] for w, _ in kept))
        follow = {}
        for triple, n in triples.items():
            follow.setdefault(ordered[triple >> _SHIFT], []).append((triple & mask, n))
        for pair, state in state_of_pair.items():
            kept, last = follow.get(pair, []), pair & mask
            for w, n in kept:
                self.arcs[state << _SHIFT | w] = (
                    math.log10((n - DISCOUNT) / pairs[pair]),
                    state_of_pair.get(last << _SHIFT | w, state_of_word.get(w, 0)))
            self._failure(state, state_of_word[last], sum(n - DISCOUNT for _, n in kept) / pairs[pair],
                          sum(of_pair[last << _SHIFT | w] for w, _ in kept))

    def _failure(self, state: int, to: int, used: float, lower: float) -> None:
        self.fail[state] = (math.log10((1 - used) / (1 - lower)), to)

    def traverse(self, numbers: list[int]) -> float:
        """log10 probability of a numbered text; a token without a root arc (-1) adds what leads
        to the root, and the traversal goes on from there."""
        arcs, fail, state, score = self.arcs, self.fail, self.start, 0.0
        for w in numbers:
            if w < 0:
                while state:
                    weight, state = fail[state]
                    score += weight
                continue
            arc = arcs.get(state << _SHIFT | w)
            while arc is None:
                weight, state = fail[state]
                score += weight
                arc = arcs.get(state << _SHIFT | w)
            score += arc[0]
            state = arc[1]
        return score


class Model:
    """Written tables: ``machine`` in ranges of its keys, and with ``grams`` the word counts and the kept
    ``pairs`` and ``triples`` with theirs. ``letters``: about how many characters the texts have."""

    def __init__(self, texts: DataFrame, grams: bool = True, letters: int | None = None):
        with scope(texts.sparkSession) as steps:
            self._build(texts, steps, grams, _letters(texts) if letters is None else letters)
            steps.keep(self.machine, *((self.counts, *self.tables) if grams else ()))

    def _build(self, texts: DataFrame, steps: Scope, grams: bool, letters: int) -> None:
        spark, bits, self.tables = texts.sparkSession, _bits(letters // 4), []

        def counted(counts_of, salt: int, name: str) -> tuple[DataFrame, object]:
            """Rows and blocks, and the filter of what may be repeated among the next larger n-grams."""
            table = staged(_counted(texts, counts_of, bits, salt), name)
            self.tables.append(table)
            return table, spark.sparkContext.broadcast(_filter(table.filter(F.col("kind") == _MAYBE).select(
                F.col("key").alias("range"), F.col("data").alias("bits")), bits))

        def of_words(found: Tokens) -> Iterator[pa.RecordBatch]:
            pair, one, _ = found.pairs()
            yield _words_of(found.hashes, bits)
            yield _maybe_of(pair.compress(one), bits)

        hashes, kept = counted(of_words, 0, "words")
        self.hashes = hashes.filter(F.col("kind") == _OF_WORDS).select(F.col("key").alias("h"), F.col("n").alias("m"))
        word = F.col("h") != _HASH_OF_BEGIN
        sums = self.hashes.agg(F.sum(F.when(word, F.col("m"))).alias("n"), F.count_if(word).alias("v"),
                               F.sum(F.when(~word, F.col("m"))).alias("e")).first()
        self.total, self.distinct, self.texts = sums["n"] or 0, sums["v"], sums["e"] or 0
        self.least = max(2, math.ceil(self.total * ARC_SHARE))

        def of_pairs(found: Tokens) -> Iterator[pa.RecordBatch]:
            pair, one, both = found.pairs()
            one &= _may_hold(kept.value, pair)
            both &= one[:-1] & one[1:]  # a repeated triple consists of two repeated pairs
            yield _grams_of(*(x.compress(one) for x in (pair, found.hashes[:-1], found.hashes[1:])), bits)
            yield _maybe_of(_key(pair[:-1].compress(both), pair[1:].compress(both), 2), bits)

        self.pairs, kept_triples = counted(of_pairs, 1, "pairs")

        def of_triples(found: Tokens) -> Iterator[pa.RecordBatch]:
            pair, one, both = found.pairs()
            one &= _may_hold(kept.value, pair)
            both &= one[:-1] & one[1:]
            a, b = pair[:-1].compress(both), pair[1:].compress(both)
            keys = _key(a, b, 2)
            good = _may_hold(kept_triples.value, keys)
            yield _grams_of(*(x.compress(good) for x in (keys, a, b)), bits)

        self.triples = staged(_counted(texts, of_triples, bits, 2), "triples")
        self.tables.append(self.triples)
        self.pairs, self.triples = (t.filter(F.col("kind") == _OF_GRAMS).select("key", "a", "b", "n")
                                    for t in (self.pairs, self.triples))
        kept.destroy()
        kept_triples.destroy()
        self.bits, self.machine = bits, staged(_ranges(self._blocks(bits), bits), "machine")
        if grams:
            self.counts = staged(word_counts(texts), "counts")
            self.words = Words([(bytes(r["word"]), r["n"]) for r in
                                self.counts.filter(F.col("n") >= self.least).collect()])

    def _blocks(self, bits: int) -> DataFrame:
        """The counts of all words, kept pairs and kept triples, and what follows words and pairs."""
        words = self.hashes
        bottom, used = float(self.total + self.distinct + 1), F.col("n") - DISCOUNT
        frequent = F.col("m") >= self.least
        frequent_pair = F.col("m") >= max(LEAST, math.ceil(self.total * GRAM_SHARE))
        ending = _attached(self.pairs.select("a", "b", "n"), "b", words.withColumnRenamed("h", "b"), frequent).select(
            "a", used.alias("used"), ((F.col("m") + 1) / bottom).alias("lower"))
        arcs = staged(_attached(self.pairs.select("key", "a", "n"), "a", words.withColumnRenamed("h", "a"),
                                frequent).select(F.col("key").alias("b"), F.col("n").alias("m"),
                                                 (used / F.col("m")).alias("p2")), "pair-arcs")
        over = _attached(self.triples.select("a", "b", "n"), "b", arcs, frequent_pair).select(
            "a", used.alias("used"), F.col("p2").alias("lower"))
        counts = reduce(DataFrame.unionByName, (t.filter(F.col("kind") == _BLOCK) for t in self.tables)).select(
            F.col("key").alias("range"), F.col("data").alias("keys"), F.col("more").alias("n"),
            F.lit(None).cast("binary").alias("used"), F.lit(None).cast("binary").alias("lower"))
        return reduce(DataFrame.unionByName, (_followed(rows, bits) for rows in (ending, over)), counts)

    def _hot(self) -> Hot:
        """The most frequent rows of the machine, at most ``HOT``."""
        def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = sum((_joined(batch["sizes"], "<i8").reshape(-1, _SIZES).sum(axis=0) for batch in slices(batches)),
                    np.zeros(_SIZES, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(k)), pa.array(k[k > 0])], names=["size", "k"])

        found = self.machine.select("sizes").mapInArrow(sizes, "size long, k long").groupBy("size").agg(
            F.sum("k").alias("k")).collect()
        least, held = _SIZES, 0
        for r in sorted(found, key=lambda r: -r["size"]):
            held += r["k"]
            if held > HOT:
                break
            least = r["size"]

        def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, n, weight in _rows_of(batches):
                some = _size(n) >= least
                yield pa.RecordBatch.from_arrays([_longs(keys[some]), pa.array(n[some]), pa.array(weight[some])],
                                                 names=["key", "n", "weight"])

        rows = self.machine.drop("bits", "sizes").mapInArrow(frequent, "key long, n long, weight double").toArrow()
        n = rows["n"].to_numpy()
        return Hot(rows["key"].to_numpy().view(np.uint64),
                   np.column_stack([n.astype(np.float64), rows["weight"].to_numpy()]), n)

    @property
    def automaton(self) -> Automaton:
        """The model in memory, to look into it; only of texts whose repeated words are all numbered."""
        if self.least > LEAST:
            raise ValueError("the training texts are too large for an automaton in memory")
        number = {int(h): i for i, h in enumerate(self.words.hashes.view(np.int64))} | {
            _HASH_OF_BEGIN: _BEGIN}
        rows = self.pairs.collect()
        pair = {r["key"]: number[r["a"]] << _SHIFT | number[r["b"]] for r in rows}
        place = {p: i for i, p in enumerate(sorted(pair.values()))}
        triples = {place[pair[r["a"]]] << _SHIFT | pair[r["b"]] & (1 << _SHIFT) - 1: r["n"]
                   for r in self.triples.collect()}
        return Automaton(self.words, self.total, self.distinct,
                         {pair[r["key"]]: r["n"] for r in rows}, triples, self.texts)

    def score(self, docs: DataFrame, letters: int | None = None) -> DataFrame:
        """doc_id, n_tokens, n_known, base_score, score of (doc_id, text)."""
        bottom = float(self.total + self.distinct + 1)
        bits = _bits(max(self.total, (_letters(docs) if letters is None else letters) // 4))

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A row with the texts of each slice (range -1), and rows with the keys it asks of a range."""
            hot, kept = shared.value
            number = TaskContext.get().partitionId() << 32
            for part in _parts(batches, _SCORED):
                keys = Wanted(Tokens(part.column(1)), hot, kept, told=False).keys
                ranges, ends = _runs(keys, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * (len(ends) + 1), pa.int64()),
                     pa.array([-1, *ranges.tolist()], pa.int64()),
                     pa.array([_written(part), *(_planes(keys[i:j]) for i, j in ends)], pa.binary())],
                    names=["slice", "range", "data"])
                number += 1

        def answered(rows: pa.Table, questions: pa.Table) -> pa.Table:
            keys, n, weight = (
                np.concatenate([np.zeros(0, kind), *(_of_planes(x, kind) for x in rows[name].to_pylist()),
                                np.zeros(1, kind)])  # one more, which no key is equal to
                for name, kind in (("keys", "<u8"), ("n", "<i8"), ("weight", "<f8")))
            of_n, of_weight = [], []
            for data in questions["data"].to_pylist():
                wanted = _of_planes(data, "<u8")
                at = np.searchsorted(keys[:-1], wanted)
                at[keys.take(at) != wanted] = len(keys) - 1
                of_n.append(_planes(n.take(at)))
                of_weight.append(_planes(weight.take(at)))
            return pa.table({"slice": questions["slice"], "range": questions["range"],
                             "n": pa.array(of_n, pa.binary()), "weight": pa.array(of_weight, pa.binary())})

        def scores(texts: pa.Table, told: pa.Table) -> pa.Table:
            hot, kept = shared.value
            part = pa.ipc.open_stream(texts["data"][0].as_buffer()).read_all()
            found, n = Tokens(part.column(1).combine_chunks()), part.num_rows
            wanted = Wanted(found, hot, kept)
            told = told.sort_by("range")
            rows = np.zeros((len(wanted.keys), 2))
            for at, name, kind in ((0, "n", "<i8"), (1, "weight", "<f8")):
                rows[:, at] = np.concatenate(
                    [np.zeros(0), *(_of_planes(x, kind) for x in told[name].to_pylist())])

            of_words, of_pairs, of_triples = wanted.rows(rows)
            begins = np.append(True, found.text[1:] != found.text[:-1])
            seen = np.where(begins, 0, of_words[:, 0])
            root = np.where(begins, 0.0, np.log10((seen + 1) / bottom))
            with np.errstate(divide="ignore", invalid="ignore"):
                pair_arc = np.where(wanted.one & (of_pairs[:, 0] > 0), np.log10(
                    (of_pairs[:, 0] - DISCOUNT) / of_words[:-1, 0]), np.nan)
                triple_arc = np.where(wanted.both & (of_triples[:, 0] > 0), np.log10(
                    (of_triples[:, 0] - DISCOUNT) / of_pairs[:-1, 0]), np.nan)
            adds = traverse(root, of_words[:, 1], pair_arc, of_pairs[:, 1], triple_arc)
            score = np.bincount(found.text, np.where(begins, 0.0, adds), n)
            known = np.bincount(found.text, seen > 0, n).astype(np.int64)
            return pa.Table.from_arrays(
                [part.column(0), pa.array(found.lengths, pa.int64()), pa.array(known),
                 pa.array(np.bincount(found.text, root, n)), pa.array(score, pa.float64())],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

        def scored(some: DataFrame) -> DataFrame:
            blocks = staged(some.mapInArrow(asked, "slice long, range long, data binary"), "asked")
            told = ranges.drop("bits", "sizes").groupBy("range").cogroup(blocks.filter("range >= 0").groupBy("range")).applyInArrow(
                answered, "slice long, range long, n binary, weight binary")
            return staged(blocks.filter("range < 0").groupBy("slice").cogroup(
                told.groupBy("slice")).applyInArrow(scores, f"doc_id {id_type(docs)}, n_tokens long, "
                              "n_known long, base_score double, score double"), "scored")

        with scope(docs.sparkSession) as steps:
            ranges = self.machine if bits == self.bits else staged(_ranges_again(self.machine, bits), "ranges")
            shared = docs.sparkSession.sparkContext.broadcast((self._hot(), _filter(ranges, bits)))
            turn, found = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_ROUNDS)), []
            for k in range(_ROUNDS):
                with scope(docs.sparkSession) as round_steps:
                    found.append(scored(docs.filter(turn == k)))
                    round_steps.keep(found[-1])
            steps.keep(*found)
        return reduce(DataFrame.unionByName, found)


def _followed(rows: DataFrame, bits: int) -> DataFrame:
    """Blocks of what rows of (a, used, lower) add to the contexts a, added up where many rows meet."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks() -> pa.RecordBatch:
            some = pa.Table.from_batches(held)
            keys, order, starts = _distinct(some["a"].to_numpy().view(np.uint64))
            used, lower = (np.add.reduceat(some[c].to_numpy().take(order), starts) for c in ("used", "lower"))
            ranges, ends = _runs(keys, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(ranges), pa.array([_planes(keys[i:j]) for i, j in ends], pa.binary()),
                 pa.nulls(len(ends), pa.binary()), *(pa.array([x[i:j].tobytes() for i, j in ends], pa.binary())
                                                     for x in (used, lower))],
                names=["range", "keys", "n", "used", "lower"])

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _RANGE:
                yield blocks()
                held, size = [], 0
        if size:
            yield blocks()

    return rows.mapInArrow(work, _OF_MACHINE)


_OF_RANGES = "range long, keys binary, n binary, weight binary, bits binary, sizes binary"
_SIZES = 512  # of eighths of powers of two


def _range(first: int, keys: np.ndarray, n: np.ndarray, weight: np.ndarray, bits: int) -> pa.Table:
    """The row of a range: its sorted keys with their rows, its bits of the filter, and how many rows
    have a count of which size."""
    return pa.table({"range": pa.array([first], pa.int64()), **{
        c: pa.array([_planes(x)], pa.binary()) for c, x in (("keys", keys), ("n", n), ("weight", weight))},
        "bits": pa.array([_segment(first, keys, bits)], pa.binary()),
        "sizes": pa.array([np.bincount(_size(n), minlength=_SIZES).tobytes()], pa.binary())})


def _ranges(blocks: DataFrame, bits: int) -> DataFrame:
    """The machine: a row for each range of keys, with the failure weights (0 where nothing follows)."""
    def merged(rows: pa.Table) -> pa.Table:
        counted, adds = (rows.filter(test(rows["n"])) for test in (pc.is_valid, pc.is_null))
        keys, n = _of_blocks(counted["keys"], "<u8"), _of_blocks(counted["n"], "<i8")
        order = np.argsort(keys)
        keys, n, weight = keys[order], n[order], np.zeros(len(keys))
        contexts, order, starts = _distinct(_of_blocks(adds["keys"], "<u8"))
        if len(contexts):
            used, lower = (np.add.reduceat(_joined(adds[c], "<f8")[order], starts) for c in ("used", "lower"))
            at = np.searchsorted(keys, contexts)
            weight[at] = np.log10((1 - used / n[at]) / (1 - lower))
        return _range(rows["range"][0].as_py(), keys, n, weight, bits)

    return blocks.groupBy("range").applyInArrow(merged, _OF_RANGES)


def _ranges_again(machine: DataFrame, bits: int) -> DataFrame:
    """The machine in other ranges."""
    names = ["range", "keys", "n", "weight"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _rows_of(batches):
            ranges, ends = _runs(columns[0], bits)
            yield pa.RecordBatch.from_arrays([pa.array(ranges), *(
                pa.array([_planes(x[i:j]) for i, j in ends], pa.binary()) for x in columns)], names=names)

    def ordered(rows: pa.Table) -> pa.Table:
        keys, n, weight = (_of_blocks(rows[c], kind) for c, kind in zip(names[1:], ("<u8", "<i8", "<f8")))
        order = np.argsort(keys)
        return _range(rows["range"][0].as_py(), keys[order], n[order], weight[order], bits)

    return machine.select(*names).mapInArrow(work, "range long, keys binary, n binary, weight binary").groupBy(
        "range").applyInArrow(ordered, _OF_RANGES)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted keys, counts and weights of one range of the machine after the other."""
    for batch in slices(batches, 1):
        yield tuple(_of_blocks(batch[c], kind) for c, kind in (("keys", "<u8"), ("n", "<i8"), ("weight", "<f8")))


def _size(n: np.ndarray) -> np.ndarray:
    return np.floor(8 * np.log2(n)).astype(np.int64)


def _letters(docs: DataFrame) -> int:
    """How many bytes the texts have: no letters are decoded for it."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def _written(part: pa.RecordBatch) -> bytes:
    """Ids and texts of a slice, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def held_out_scores(docs: DataFrame, folds: int = 7, fold: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document,
    by a model of the documents outside the fold."""
    docs = pick(docs, id_col, text_col)
    held_out = remainder(F.col("doc_id"), folds) == fold
    letters = _letters(docs)
    model = Model(docs.filter(~held_out).select("text"), grams=False, letters=letters)
    return model.score(docs, letters).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
