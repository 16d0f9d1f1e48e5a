"""Every registered query against its SQL, over the whole tables."""

import pytest
from check import TESTDATA, compare, oracle

import __spark_entry__ as entry

SQL = entry._flow_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle(f"{TESTDATA}/sf0.01")


@pytest.mark.parametrize("name", list(entry._flow_queries()))
def test_query(spark, connection, name):
    result = entry._flow_queries()[name](spark, f"{TESTDATA}/sf0.01")
    assert compare(result, SQL[name], connection) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_flow_query_has_sql():
    assert set(entry._flow_queries()) == set(entry._flow_sql())
