"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, FOLDER, QUERIES[name], ORACLES.get(name)) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert not entry.entry(spark).isEmpty()
