"""The driver's functions."""

from __future__ import annotations

import __spark_entry__ as entry

#: Queries without SQL, and why.
NO_SQL = {
    "boosted_importance": "fitted trees", "boosted_reasons": "fitted trees", "boosted_scores": "fitted trees", "bootstrap_ci": "resamples drawn by a seeded generator", "feature_ablation": "fitted models", "gbt_scores": "fitted trees", "logistic_scores": "a fitted model", "model_reasons": "a fitted model",
    "platt_diagnostic": "a fitted model", "tree_importance": "fitted trees",
}


def test_names_agree():
    q, sql = entry.queries(), entry.oracle_sql()
    assert len(q) > 120 and set(sql) <= set(q)


def test_every_query_has_sql_or_a_reason():
    own = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert own - set(entry.oracle_sql()) == set(NO_SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
