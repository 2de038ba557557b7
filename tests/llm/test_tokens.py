"""Text encoding against the library."""
from __future__ import annotations

import gc
import weakref

import pyarrow as pa
import pytest

from lagwise.llm import bpe, near, tokens
from tests.llm import cases

TEXTS = [r[1] or "" for r in cases.rows()] + [
    "Straße ŒUVRE œuvre İstanbul ıx ǅ ªº Āā ɏ ɐ ʼn ſ", " a b", "don't we'll x's", "ÀÉÎ àéî ñÑ",
    "é ẞ ﬁ Ω ω", "abc123 1a a1", "tail ", " ", "a b", "l'été", "ŧħ ŦĦ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(spark, sf_dir, name):
    spec = tokens.read_spec(tokens.tokenizer(name))
    own = tokens.TextEncoder(spec)
    assert own._letters  # the short way is taken
    library = own._library
    docs = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    letters = [chr(c) for c in range(1, 0x260)]
    for text in TEXTS + docs + letters + [f"a{c}" for c in letters] + [f" {c}b {c}" for c in letters]:
        assert own(text) == tokens.packed_ids(library.encode(text, add_special_tokens=False).ids), repr(text[:80])


def test_without_the_short_way_ids_are_the_same():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        spec = tokens.read_spec(tokens.tokenizer(name))
        short, plain = tokens.TextEncoder(spec), tokens.TextEncoder(spec)
        plain._letters = False
        assert [short(t) for t in TEXTS] == [plain(t) for t in TEXTS]


def test_a_worker_keeps_one_operators_caches():
    """Workers go from one stage of the pipeline to the next: what the last one remembered must go."""
    spec = tokens.read_spec(tokens.tokenizer("byte_bpe_50k.json"))
    encoder = tokens.encoder(spec)
    assert tokens.encoder(spec) is encoder
    coders = weakref.ref(bpe.coders(spec)[0])
    gone = weakref.ref(encoder)
    del encoder
    near.shingles("one two three four five six")
    gc.collect()
    assert gone() is None and coders() is None


def test_latin_words_with_capitals_go_to_the_merges():
    own = tokens.TextEncoder(tokens.read_spec(tokens.tokenizer("word_bpe_49k.json")))
    by_library, asked = own._by_library, []
    text = "Éouoien Öauach ÈREÉ Straße Ǆ ŧĦx"
    own._by_library = lambda t: asked.append(t) or by_library(t)
    assert own(text) == by_library(text)
    assert asked == []
    assert own("İx Ⱥ") == by_library("İx Ⱥ")
    assert asked  # their small forms are other letters or more than one


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_many_texts_at_once_have_the_ids_of_the_library(name):
    encoder = tokens.TextEncoder(tokens.read_spec(tokens.tokenizer(name)))
    texts = TEXTS + ["", " ", ".", " .", ", ,", "a, b. 3. l'été, é! x.. y", "<|endoftext|> a<|endoftext|>",
                     "\n \n a", "日本。 日本.", "²! ª; ª"]
    for some in (texts, texts[:1], texts[::-1], []):
        column = pa.array(["left out", *some], pa.string()).slice(1)  # buffers that do not start at 0
        assert [x.tobytes() for x in encoder.arrays(column)] == [
            tokens.packed_ids(encoder._library.encode(t, add_special_tokens=False).ids) for t in some]


def test_many_texts_at_once_ask_for_a_word_once():
    encoder = tokens.TextEncoder(tokens.read_spec(tokens.tokenizer("byte_bpe_50k.json")))
    asked = []
    encoder._values.after.make = lambda part: asked.append(part) or b"\0\0\0\0"
    assert [len(x) for x in encoder.arrays(pa.array(["x word, word. word"] * 500))] == [6] * 500
    assert asked == ["word"]


def test_many_texts_at_once_ask_for_a_word_once_for_all_its_capitals():
    encoder = tokens.TextEncoder(tokens.read_spec(tokens.tokenizer("word_bpe_49k.json")))
    asked, make = [], encoder._words.make
    encoder._words.make = lambda part: asked.append(part) or make(part)
    texts = ["Word,\tword. WORD\nword!"] * 500
    want = tokens.packed_ids(encoder._library.encode(texts[0], add_special_tokens=False).ids)
    assert {x.tobytes() for x in encoder.arrays(pa.array(texts))} == {want}
    assert [w for w in asked if w not in tokens.MARKS] == ["word"]


def test_parts_of_a_text_that_change_with_their_neighbours_have_the_ids_of_the_library():
    """Marks that join the letter before them, white space beyond ASCII, and words of added tokens."""
    encoder = tokens.TextEncoder(tokens.read_spec(tokens.tokenizer("word_bpe_49k.json")))
    texts = ["J̌ ǰ Å, x́. ́ KK", "A\xa0B. C\x85D \x1cE\x1d", "ΑΣ ΑΣ. Σ", " ", "\t.\n,", "A",
             "<|startoftext|>Ab ab<|endoftext|>", "DON'T We'LL 'S", ". .A a."]
    found, ends = encoder.flat(pa.array([None, *texts]))
    want = [encoder._library.encode(t, add_special_tokens=False).ids for t in texts]
    assert found.tolist() == [i for ids in want for i in ids]
    assert ends.tolist() == [0, *(sum(map(len, want[:k + 1])) for k in range(len(want)))]
