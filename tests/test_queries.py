"""Every registered query against its SQL on the whole of a small data set."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference
from workload import scalar, tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


OWN = sorted({**scalar.QUERIES, **tables.QUERIES})


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, con, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert difference(result, con, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
