"""Every registered query against its SQL on the test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import assert_same, duckdb_on
from halfstar.plans.queries import QUERIES

SQL = oracle_sql()
#: The queries of the rating library; those of the subpackage llm have tests of their own.
NAMES = list(QUERIES)
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(SF_DIR)


def test_every_query_has_sql():
    assert set(NAMES) <= set(SQL) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, name):
    assert_same(queries()[name](spark, SF_DIR), connection, SQL[name])


def test_entry_returns_fifteen_movies(spark):
    assert entry(spark).count() == 15
