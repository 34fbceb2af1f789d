"""Every query with a SQL twin gives the twin's rows on the test tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tickloom.plans import catalog

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(name, spark, sf_dir, con):
    ok, note = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert ok, note


#: Queries that return fitted weights, or scores that follow from them, which SQL cannot state; `test_learning` compares them with numpy.
FITTED = {
    "logreg_fit", "logreg_report", "coefficient_ranking", "isotonic_calibrated", "isotonic_report", "feature_ablation", "signals_scored_fitted",
}


def test_every_tick_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) | FITTED and not FITTED & set(catalog.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
