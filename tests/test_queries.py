import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences

SQL = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
