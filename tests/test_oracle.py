"""Every query of the library equals its DuckDB oracle (driver gate, run locally). The
training-data queries, not all of which SQL can express, have their own tests in tests/llm."""

import pytest

import __spark_entry__ as E
from ledgerlens.plans import registry
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(KEYS) <= set(E.queries())
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    ok, msg = compare(df, con, E.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["prior_stage", "current_stage", "accounts", "pct_of_prior_stage"]
