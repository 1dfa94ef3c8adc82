"""Every registered query: against DuckDB where it can be said in SQL, else by shape."""

from dataclasses import replace

import pytest

import __spark_entry__ as entry
from compare import assert_same, connect
from lendwatch import oracle, queries
from lendwatch.config import FEATURES

QUERIES, STATEMENTS = entry.queries(), oracle.statements()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_duckdb(spark, small, duck, name):
    assert_same(QUERIES[name](spark, small), duck, STATEMENTS[name])


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 414


def test_preview(spark, small):
    assert QUERIES["sample_preview"](spark, small).count() == 5


def test_models(spark, small, monkeypatch):
    monkeypatch.setattr(queries, "CFG", replace(queries.CFG, gbt_iterations=10))
    table = QUERIES["model_metrics_table"](spark, small).collect()
    assert len(table) == 2 and sum(r.is_selected for r in table) == 1
    for r in table:
        assert 0 <= r.roc_auc <= 1 and abs(r.gini - (2 * r.roc_auc - 1)) < 1e-12
        assert 0 <= r.ks <= 1 and r.train_end < r.test_start
    for name in ("train_logistic", "train_gbt"):
        assert QUERIES[name](spark, small).count() == 1
    deciles = QUERIES["model_deciles_table"](spark, small).collect()
    assert [r.decil for r in deciles] == list(range(1, 11))
    importance = QUERIES["permutation_importance"](spark, small).collect()
    assert sorted(r.feature for r in importance) == sorted(FEATURES)
    scores = QUERIES["score_latest"](spark, small).collect()
    assert len(scores) == QUERIES["latest_month_population"](spark, small).count()
    assert {r.risk_band for r in scores} <= {"Alto", "Médio", "Baixo"}
