"""Every catalogue query against its DuckDB oracle (sf0.001), plus the entry contract."""

import pytest

import __spark_entry__ as E
from sparkwright.plans import catalog, oracle
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, list(catalog.queries()), verbose=False)


# Trees are grown step by step from sums; tests/test_boosting.py holds them against a plain version.
ROWS_ONLY = {"boosted_candidate_scores", "boosted_registry"}


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) - ROWS_ONLY == set(oracle.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", list(catalog.queries()))
def test_query_matches_oracle(results, key):
    assert results[key][0] == ("ROWS-ONLY" if key in ROWS_ONLY else "OK"), results[key]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "customer_id" and df.count() > 0
