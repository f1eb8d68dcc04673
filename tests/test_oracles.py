"""Every query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from compare import connection, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def tables(data):
    return connection(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, data, tables, name):
    assert difference(driver.queries()[name](spark, data), tables, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["event_type", "relevant", "n_filings"]
