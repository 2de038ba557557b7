"""SentencePiece encoding and decoding against the library."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lagwise.llm import sentencepieces as sp
from lagwise.llm.tokens import tokenizer
from tests.llm import cases

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def awkward_texts():
    draw = random.Random(7)
    mixed = ["".join(draw.choice(" \n▁ab漢.,é\t<0x0A>🙂") for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    return mixed + [r[1] or "" for r in cases.rows()] + [
        "", " ", "  ", "\n", "\n\n a\n \n", "a ▁b", "▁", "\0x \0", "<s> </s> <unk> ⁇", " \n", "x" * 3000 + " y"]


def test_ids_and_texts_are_those_of_the_library(awkward_texts, library):
    own = sp.Pieces(sp.read_model(PATH))
    assert own.cuts and own.cuts_lines
    ids = own.encode(awkward_texts)
    assert [i.tolist() for i in ids] == library.encode(awkward_texts, add_bos=True, add_eos=True)
    assert [own.decode(i).decode() for i in ids] == [library.decode(i.tolist()) for i in ids]


def test_a_small_table_gives_the_same(awkward_texts, monkeypatch):
    own = sp.Pieces(sp.read_model(PATH))
    whole = [i.tolist() for i in own.encode(awkward_texts)]
    monkeypatch.setattr(sp, "REMEMBERED", 5)
    monkeypatch.setattr(sp, "LONGEST", 2)
    small = sp.Pieces(sp.read_model(PATH))
    assert [small.encode([t])[0].tolist() for t in awkward_texts] == whole
    assert len(small.table) < 50


def test_without_cuts_texts_are_segmented_whole(awkward_texts):
    own = sp.Pieces(sp.read_model(PATH))
    whole = [i.tolist() for i in own.encode(awkward_texts)]
    own = sp.Pieces(sp.read_model(PATH))
    own.cuts = own.cuts_lines = False
    assert [i.tolist() for i in own.encode(awkward_texts)] == whole
    own = sp.Pieces(sp.read_model(PATH))
    own.cuts_lines = False
    assert [i.tolist() for i in own.encode(awkward_texts)] == whole


def test_decoding_any_ids(library):
    own, draw = sp.Pieces(sp.read_model(PATH)), random.Random(3)
    for _ in range(3000):
        ids = [draw.randrange(32000 if draw.random() < .5 else 300) for _ in range(draw.randint(0, 6))]
        assert own.decode(np.asarray(ids, dtype=np.int64)).decode() == library.decode(ids), ids


def test_each_distinct_chunk_is_segmented_once():
    own = sp.Pieces(sp.read_model(PATH))
    asked, plain = [], own._segment
    own._segment = lambda chunks: asked.extend(chunks) or plain(chunks)
    own.encode(["a b a b\na b", "b a c"])
    own.encode(["c a"])
    assert sorted(asked) == ["\na", "a", "b", "c"]


def test_digests_of_awkward_rows(spark, library):
    got = sp.roundtrip(cases.awkward(spark), PATH).collect()
    assert len(got) == len(cases.rows())

    def digests(text: str) -> tuple:
        ids = library.encode(text, add_bos=True, add_eos=True)
        return (len(ids), hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())

    want = [(r[0], *digests(r[1] or "")) for r in cases.rows()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_all_texts_of_the_test_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for row in sp.encode(docs, PATH).collect():
        assert row["ids"] == library.encode(texts[row["doc_id"]], add_bos=True, add_eos=True)


def test_encode_and_decode_as_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "é\n ▁")], "doc_id long, text string")
    encoded = sp.encode(docs, PATH, begin=False)
    back = sp.decode(encoded.unionByName(spark.sql(
        "SELECT CAST(9 AS BIGINT) AS doc_id, CAST(NULL AS array<int>) AS ids")), PATH)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, [
        (1, "a b"), (1, "a b"), (None, ""), (2, "é\n  "), (9, None)]))


def test_other_columns_do_not_matter(spark):
    docs = cases.awkward(spark)
    assert cases.same_rows(sp.roundtrip(docs, PATH), sp.roundtrip(cases.crowded(docs), PATH))
    other = docs.select(F.col("doc_id").alias("a.b"), F.col("text").alias("ids"))
    assert cases.same_rows(sp.roundtrip(docs, PATH), sp.roundtrip(other, PATH, "a.b", "ids"))


def test_empty_table(spark):
    assert sp.roundtrip(cases.empty(spark), PATH).count() == 0
    assert sp.encode(cases.empty(spark), PATH).count() == 0
