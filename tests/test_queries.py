"""Every registered query against its SQL twin, and shape checks where there is none."""
import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences

SQLS, QUERIES = oracle_sql(), queries()
MODELS = ("lr_fit", "lr_context_fit", "rf_fit", "gbt_fit", "lr_weighted")


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQLS[name]) == []


def test_only_known_queries_have_sql():
    assert set(SQLS) <= set(QUERIES)


def test_entry_has_one_row_per_impression(spark):
    df = entry(spark)
    assert df.count() == 1000
    assert len(df.columns) == len(set(df.columns)) == 40


@pytest.mark.parametrize("name", MODELS)
def test_model_scores_are_probabilities(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 110
    assert all(0 <= r["p_calibrated"] <= 1 for r in rows)
    mean = sum(r["p_calibrated"] for r in rows) / len(rows)
    assert 0.3 < mean / (30 / 110) < 3


def test_model_scores_do_not_depend_on_the_run(spark, sf_dir):
    first, second = [
        {r["event_id"]: r["p_calibrated"] for r in QUERIES["lr_fit"](spark, sf_dir).collect()}
        for _ in range(2)]
    assert first.keys() == second.keys()
    assert all(math.isclose(first[k], second[k], abs_tol=1e-9) for k in first)


def test_assembled_vectors_have_one_width(spark, sf_dir):
    rows = QUERIES["assemble_features"](spark, sf_dir).collect()
    assert len({r["slots"] for r in rows}) == 1 and len(rows) == 110


def test_grid_has_one_best_point(spark, sf_dir):
    rows = QUERIES["cv_tune"](spark, sf_dir).collect()
    assert sum(r["best"] for r in rows) == 1
    assert max(rows, key=lambda r: r["cv_auc_pr"])["best"]


def test_weights_cover_every_slot(spark, sf_dir):
    weights = QUERIES["feature_weights"](spark, sf_dir).collect()
    slots = QUERIES["assemble_features"](spark, sf_dir).first()["slots"]
    names = [r["feature"] for r in weights]
    assert len(names) == len(set(names))
    assert abs(sum(r["rel_pct"] for r in weights) - 100) < 1e-6
    assert names and slots >= 19


def test_als_gives_k_items_per_user(spark, sf_dir):
    rows = QUERIES["als_topk"](spark, sf_dir).collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r["userid"], []).append(r)
    for items in per_user.values():
        items.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in items] == list(range(1, 11))
        assert len({r["item"] for r in items}) == 10
        scores = [r["score"] for r in items]
        assert scores == sorted(scores, reverse=True)
    ranked = QUERIES["als_ranking"](spark, sf_dir).first()
    assert 0 < ranked["users_evaluated"] <= ranked["users_with_truth"]
    assert 0 <= ranked["ndcg_at_k"] <= 1
