"""Every registered query against the same query in SQL."""

import pytest

import __spark_entry__ as contract
from tarmac.plans import catalog
from tests.oracle import compare, connect

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, small, con, name):
    assert compare(contract.queries()[name](spark, small), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(catalog.QUERIES) <= set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() == 54
