"""Every registered query against its SQL twin in DuckDB."""

import pytest
from compare import connect, difference

from salesmart.oracle import oracle_sql
from salesmart.registry import all_queries

QUERIES, SQL = all_queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, duck, name):
    assert difference(QUERIES[name](spark, small), duck, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_log_is_newest_first(spark, small):
    rows = QUERIES["full_refresh_log"](spark, small).collect()
    assert [r.log_id for r in rows] == list(range(7, 0, -1))
