"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from reelspark import queries
from verify.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
OWN = sorted(queries.registered())


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(OWN) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", OWN)
def test_same_rows(spark, duck, name):
    ok, note = compare(spark, duck, contract.queries()[name], SQL[name], FOLDER)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() == 150
