"""Every registered query gives the rows of its SQL."""

import pytest

from tests.compare import connection, difference
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.columns == ["year", "month_name", "month_number", "total_revenue", "total_orders", "aov"]
    assert df.count() > 0
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())
