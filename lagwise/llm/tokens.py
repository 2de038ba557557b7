"""Token ids of whole texts by the tokenizers library, one call per distinct chunk of text.

A text is cut only where the tokenizer itself always cuts, so the ids of the chunks in a row are
the ids of the text. Repeated chunks are then a dictionary lookup; of many texts at once, a chunk is
looked up once and its ids are gathered to all places where it stands.
"""
from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The Unicode property White_Space, which `\\s` means to the tokenizers.
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: A word with at most one space before it, or white space that no word takes.
BYTE_CHUNKS = re.compile(
    f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
BETWEEN_SPACE = re.compile(f"[{WHITE_SPACE}] [{WHITE_SPACE}]")
WORD_CHUNKS = re.compile(f"[^{WHITE_SPACE}]+")
#: What byte-level vocabularies call each byte: printable bytes themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_NAMES = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: What they call the bytes of Latin letters.
_NAMES = {chr(c): "".join([BYTE_NAMES[b] for b in chr(c).encode()]) for c in range(0x250) if chr(c).isalpha()}
_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]
#: Chunks that a worker remembers in each of two generations, and the longest that it does.
REMEMBERED, LONGEST = 1 << 19, 64
#: Rows and characters that are encoded at once; a longer text is alone.
ROWS, LETTERS = 4096, 1 << 23


MARKS = frozenset(".,;:!?|")


class ChunkCache(dict):
    """chunk -> what ``make`` gives for it.

    When ``most`` chunks are in, they become the old generation, from which a chunk that is
    seen again comes back; the old generation before that is forgotten.
    """

    def __init__(self, make, most: int | None = None):
        super().__init__()
        self.make, self.most = make, most or REMEMBERED
        self.old: dict = {}

    def __missing__(self, chunk):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value


_HELD: dict = {}


def held(key, make):
    """What ``make`` gave in this worker process, kept between tasks until another key is asked for.

    Workers outlive operators: one that goes on to the next must not keep the caches of the last.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def words_of(text: str) -> list[str]:
    """Runs without white space; str.split is faster, but also splits at four control characters."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return WORD_CHUNKS.findall(text)
    return text.split()


def stem_and_mark(chunk: str) -> tuple[str, str] | None:
    """A chunk of letters (a space may come first) and one mark as these two; the patterns of these
    tokenizers always cut between letters and marks."""
    if chunk[-1:] in MARKS and chunk[:-1].lstrip(" ").isalpha():
        return chunk[:-1], chunk[-1]
    return None


def packed_ids(ids: list[int]) -> bytes:
    """As little-endian unsigned 32-bit integers."""
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


def added_tokens(spec: str) -> list[str]:
    return [t["content"] for t in json.loads(spec)["added_tokens"]]


def vocabulary_size(spec: str) -> int:
    data = json.loads(spec)
    return 1 + max([*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"])])


class SpacedChunks:
    """Values of the byte-level chunks of a text, each value made once while it is remembered.

    A text is split at spaces, which is faster than by a pattern: a space always starts a chunk,
    unless it has white space on both sides. Other white space is cut out of the parts that hold
    it. ``whole`` gives the value of a chunk, ``joined`` the value of several in a row.
    """

    def __init__(self, whole, joined):
        self.whole, self.joined = whole, joined
        self.start = ChunkCache(self._start)  # chunk
        self.after = ChunkCache(self._after)  # part of a text that follows a space

    def _start(self, chunk: str):
        parts = stem_and_mark(chunk)
        if parts:
            return self.joined([self.start[parts[0]], self.start[parts[1]]])
        return self.whole(chunk)

    def _after(self, part: str):
        if part.isalpha():
            return self.whole(" " + part)
        parts = stem_and_mark(part)
        if parts:
            return self.joined([self.after[parts[0]], self.start[parts[1]]])
        chunks = BYTE_CHUNKS.findall(" " + part)
        if len(chunks) == 1:
            return self.whole(chunks[0])
        return self.joined([self.after[c[1:]] if c[0] == " " and len(c) > 1 else self.start[c]
                            for c in chunks])

    def __call__(self, text: str) -> list:
        if BETWEEN_SPACE.search(text):
            start = self.start
            return [start[c] for c in BYTE_CHUNKS.findall(text)]
        first, *parts = text.split(" ")
        after = self.after
        out = [after[p] for p in parts]
        return self.first(first) + out

    def first(self, part: str) -> list:
        """Values of what precedes the first space of a text."""
        return [self.start[c] for c in BYTE_CHUNKS.findall(part)]


class TextEncoder:
    """Whole texts to ids, for tokenizers that keep (byte level) or drop white space.

    ``spec`` is the content of the tokenizer file. A text that holds an added token goes to the
    library whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_str(spec)
        self._library.no_truncation()
        self._library.no_padding()
        self._added = added_tokens(spec)
        data = json.loads(spec)
        self._tokenize = self._library.model.tokenize
        self._lower = '"Lowercase"' in json.dumps(data.get("normalizer"))
        self._letters = all(self._of_letters(w) == self._by_library(w) for w in (
            "a", " a", "the", " the", "zqxj", " zqxj", "straße", " été", "ŧħ"))
        if (data.get("pre_tokenizer") or {}).get("type") == "ByteLevel":
            self._values = SpacedChunks(self._whole, b"".join)
        else:
            self._words = ChunkCache(self._word)
            self._values = self._word_values

    def _by_library(self, text: str) -> bytes:
        return packed_ids(self._library.encode(text, add_special_tokens=False).ids)

    def _of_letters(self, text: str) -> bytes:
        """Ids of one word by the merges alone: there is nothing to normalise or to cut in it."""
        if text[:1] == " ":
            space, text = "" if self._lower else BYTE_NAMES[32], text[1:]  # some drop white space
        else:
            space = ""
        if not text.isascii():  # other letters are named by themselves
            text = "".join([_NAMES[c] for c in text])
        return packed_ids([t.id for t in self._tokenize(space + text)])

    def _whole(self, text: str) -> bytes:
        """A word of (lower-case) Latin letters goes to the merges, all else through the library."""
        word = text[1:] if text[:1] == " " else text
        if self._letters and word.isalpha() and (word.isascii() or max(word) < "\u0250") and not (
                self._lower and word != word.lower()):
            return self._of_letters(text)
        return self._by_library(text)

    def _word(self, chunk: str) -> bytes:
        """A new word from known parts, if a mark follows it or it has capitals."""
        letters = chunk.isalpha()
        if not letters and (parts := stem_and_mark(chunk)):
            return self._words[parts[0]] + self._words[parts[1]]
        if self._lower and chunk != (small := chunk.lower()) and (
                chunk.isascii() or letters and len(small) == len(chunk) and max(chunk + small) < "\u0250"):
            return self._words[small]
        return self._of_letters(chunk) if letters and self._letters and chunk.isascii() else self._whole(chunk)

    def _word_values(self, text: str) -> list[bytes]:
        words = self._words
        return [words[c] for c in words_of(text)]

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(t in text for t in self._added):
            return self._whole(text)
        return b"".join(self._values(text))

    def _of_parts(self, parts: pa.StringArray) -> list[bytes]:
        """Ids of distinct parts that follow a space (or white space, where that is dropped); a word of
        letters is looked up once for all marks that may come after it, and for all its capitals."""
        if isinstance(self._values, SpacedChunks):
            after, start = self._values.after, self._values.start
        else:
            after = start = self._words
            if self._lower:  # other letters may become one with what follows them
                parts = pc.if_else(pc.string_is_ascii(parts), pc.ascii_lower(parts), parts)
        marks = sorted(MARKS)
        ends = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset:][:len(parts) + 1].astype(np.int64)
        which = np.zeros(len(parts), dtype=np.int64)  # 0: no mark
        long = np.flatnonzero(np.diff(ends) > 1)
        number = np.zeros(256, dtype=np.int64)
        number[[ord(m) for m in marks]] = np.arange(1, len(marks) + 1)
        if len(long):
            which[long] = number[np.frombuffer(parts.buffers()[2], np.uint8)[ends[long + 1] - 1]]
        marked = which > 0
        stems = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(parts, 0, -1), parts).dictionary_encode()
        at, names = stems.indices.to_numpy().copy(), stems.dictionary.to_pylist()
        alone = marked & ~np.fromiter(map(str.isalpha, names), bool, len(names))[at]
        asked = np.zeros(len(names), dtype=bool)
        asked[at[~alone]] = True
        values = list(map(after.get, names))
        for i in np.flatnonzero(asked).tolist():
            if values[i] is None:
                values[i] = after[names[i]]
        ends_with = [b"", *(start[m] for m in marks)]
        at[alone], which[alone] = len(values), 0
        values.append(b"")
        out = [values[i] + ends_with[j] if j else values[i] for i, j in zip(at.tolist(), which.tolist())]
        for i in np.flatnonzero(alone).tolist():
            out[i] = after[parts[i].as_py()]
        return out

    def flat(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where those of each text end. All texts are encoded at
        once: each part between spaces (for tokenizers that drop it: white space) is looked up once."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        plain = texts.to_pylist()
        if not plain:
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        spaced = isinstance(self._values, SpacedChunks)
        odd = [any(a in t for a in self._added) or spaced and bool(BETWEEN_SPACE.search(t)) for t in plain]
        if any(odd):  # these are encoded one by one, as the only part of their text
            texts = pa.array(["" if o else t for o, t in zip(odd, plain)], pa.string())
        parts = pc.split_pattern(texts, " ") if spaced else pc.ascii_split_whitespace(texts)
        ends = parts.offsets.to_numpy().astype(np.int64)
        begins, ends = ends[:-1], ends[1:]
        found = parts.values.dictionary_encode()
        at = found.indices.to_numpy().astype(np.int64)
        if spaced:
            later = np.ones(len(at), dtype=bool)
            later[begins] = False
            follows = np.zeros(len(found.dictionary), dtype=bool)
            follows[at[later]] = True
            number = np.cumsum(follows) - 1  # parts that only come first are not looked up
            at = number[at]
            values = self._of_parts(found.dictionary.filter(pa.array(follows)))
            at[begins] = np.arange(len(values), len(values) + len(plain))
            values += [self(t) if o else b"".join(self._values.first(t[:t.index(" ")] if " " in t else t))
                       for o, t in zip(odd, plain)]
        else:
            values = self._of_parts(found.dictionary)
            whole = np.flatnonzero(odd)
            at[begins[whole]] = np.arange(len(values), len(values) + len(whole))
            values += [self(plain[i]) for i in whole.tolist()]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts = np.cumsum(sizes) - sizes
        sizes, starts = sizes.take(at), starts.take(at)
        places = np.append(0, np.cumsum(sizes))
        ids = np.frombuffer(b"".join(values), "<u4").take(
            np.repeat(starts - places[:-1], sizes) + np.arange(places[-1]))
        return ids, places.take(ends)

    def arrays(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text."""
        ids, ends = self.flat(texts)
        return np.split(ids, ends[:-1]) if len(ends) else []


def encoder(spec: str) -> TextEncoder:
    """One encoder per worker process and tokenizer."""
    return held(("encoder", hash(spec)), lambda: TextEncoder(spec))


def read_spec(path: str) -> str:
    """The tokenizer file, read on the driver (under 2 MB) and sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenizer(name: str) -> str:
    """Where the public tokenizer file of this name is installed."""
    import public_tokenizers
    return public_tokenizers.path(name)
