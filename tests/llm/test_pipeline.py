"""The pipeline's stages on planted cases, and the whole run."""
import corpus_pipeline
from lagwise.llm import near
from lagwise.llm.common import documents
from tests.llm import cases


def test_stages_are_the_five():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "secret_scan", "packing"]


def test_each_stage_takes_effect(spark, sf_dir):
    docs = documents(spark, sf_dir)
    more = spark.createDataFrame(
        [(90_000, "12 34 ?", "en", "s", 7), (90_001, None, None, None, None),
         (90_002, cases.PROSE, "en", "s", 1), (90_003, cases.PROSE, "en", "s", 1),
         (90_004, cases.PROSE + " and token = abcdefgh12", "en", "s", 1)], docs.schema)
    docs = docs.unionByName(more)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = docs
    ids = {name: {r["doc_id"] for r in df.collect()} for name, df in seen.items()}
    assert not {90_000, 90_001} & ids["language_id"]
    assert 90_002 not in ids["exact_dedup"] and 90_003 in ids["exact_dedup"]
    assert {90_003, 90_004} & ids["near_dedup"] == {90_003}
    assert near.near_duplicates(seen["near_dedup"]).filter("not kept").count() == 0
    assert ids["secret_scan"] == ids["near_dedup"] == ids["packing"]
    for name in ("language_id", "exact_dedup", "near_dedup", "secret_scan"):
        assert seen[name].schema.names == documents(spark, sf_dir).columns


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0


def test_run_packs_what_is_left(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.count() > 0 and "ids" in pieces.columns
