"""Every query beside its SQL on the smallest data."""

import pytest

import __spark_entry__ as contract
from tests.check import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
