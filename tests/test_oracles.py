"""Every registered query against DuckDB on the same tables."""

import os

import pytest

import __spark_entry__ as contract
from contract.bindings import QUERIES
from contract.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_of_the_mart_has_its_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    result = contract.queries()[name](spark, FOLDER)
    assert differences(result, connection, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
