"""Every registered query gives the same result as its SQL on the smallest test data."""

import pytest

import parity
from wattloom import oracle, registry

QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def second_engine(sf):
    con = parity.second_engine(sf)
    yield con
    con.close()


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, second_engine, name):
    assert parity.differences(QUERIES[name](spark, sf), second_engine, SQL[name]) == ""
