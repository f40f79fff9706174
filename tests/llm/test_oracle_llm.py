"""Registered queries of the operators against their SQL."""

import pytest

from compare import assert_same, duckdb_on
from halfstar.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(SF_DIR)


def test_sql_is_of_registered_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, connection, name):
    assert_same(QUERIES[name](spark, SF_DIR), connection, ORACLE[name])
