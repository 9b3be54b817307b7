"""Every registered query against its SQL on the smallest tables."""
import pytest

import __spark_entry__ as driver
from compare import differences, duck

SF = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF, QUERIES[name], SQL[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
