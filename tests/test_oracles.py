"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tickforge.plans import registry
from tests.conftest import SF001
from tests.oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()
# The optional training-data queries are checked by tests of their own.
OWN = sorted(set(QUERIES) & set(registry.QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(OWN) == set(registry.QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF001), con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "avg_return", "volatility", "avg_price", "avg_volume", "last_update"]
    assert df.count() == 5
