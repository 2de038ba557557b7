"""The Merkle manifest against a plain build of the same tree."""
from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lagwise.llm import merkle
from tests.llm import cases


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple, text: str | None) -> str:
    doc_id, _, lang, source, n_chars = row
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}"
                    for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root of some nodes, and for each of them the (before, after) of every step."""
    steps: list[list[tuple[str, str]]] = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, p in enumerate(place):
            run, slot = runs[p // 3], p % 3
            steps[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            place[k] = p // 3
        nodes = [digest(*run) for run in runs]
    return nodes[0], steps


def expected(rows: list[tuple]) -> list[tuple]:
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in sources:
        some = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        built[s] = (some, *climb([leaf(r, r[1]) for r in some]))
    root, over = climb([built[s][1] for s in sources])
    out = []
    for k, s in enumerate(sources):
        some, subroot, steps = built[s]
        for row, own in zip(some, steps):
            path = own + over[k]
            text, name = row[1], "" if row[0] is None else str(row[0])
            seen = text.replace("\n", "") if text is not None and zlib.crc32(name.encode()) % 2 == 0 else text
            at = leaf(row, seen)
            for before, after in path:
                at = digest(before, at, after)
            out.append((row[0], leaf(row, text), subroot, root, digest(*(b + a for b, a in path)), at, at == root))
    return out


def check(spark, rows: list[tuple]) -> None:
    got = merkle.tamper_check(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected(rows)))


def test_awkward_rows(spark):
    check(spark, cases.rows())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_sizes_of_one_source(spark, n):
    check(spark, [(i, f"text {i}\nline", "en", "s", i) for i in range(n)])


def test_many_sources(spark):
    check(spark, [(i, f"a\nb{i}", None, f"s{i % 29}é" if i % 31 else None, 3) for i in range(300)])


def test_blocks_do_not_cut_runs(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 9)
    check(spark, [(i, f"a\nb{i}", "en", "hot" if i % 3 else "cold", i) for i in range(200)])


def test_repeated_rows_are_leaves(spark):
    check(spark, [(5, "same\n", "en", "s", 1)] * 40 + [(None, "x", None, None, None)] * 3)


def test_empty_table(spark):
    assert merkle.tamper_check(cases.empty(spark)).count() == 0
    found = merkle.manifest(merkle.leaves(cases.empty(spark)))
    assert found.root().count() == 0 and found.nodes().count() == 0


def test_other_columns_do_not_matter(spark):
    docs = cases.awkward(spark)
    assert cases.same_rows(merkle.tamper_check(docs), merkle.tamper_check(cases.crowded(docs)))


def test_any_partitioning_gives_the_same(spark):
    docs = cases.awkward(spark)
    assert cases.same_rows(merkle.tamper_check(docs.repartition(1)), merkle.tamper_check(docs.repartition(13)))


def test_a_lost_text_is_found(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 4}", 2) for i in range(50)], cases.SCHEMA)
    changed = {"text": F.when(F.col("doc_id") == 17, F.lit("other")).otherwise(F.col("text"))}
    out = merkle.verified(merkle.manifest(merkle.leaves(docs, changed=changed)).proofs())
    assert [r["key"] for r in out.filter(~F.col("verified")).collect()] == [17]
    assert merkle.manifest(merkle.leaves(docs)).nodes().filter("level = 0").count() == 50
