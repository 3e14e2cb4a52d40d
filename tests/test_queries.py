"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences, oracle_connection

SF_DIR = driver.SMOKE_DIR
QUERIES, ORACLE = driver.QUERIES, driver.ORACLE


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, connection, ORACLE[name]) == []
    assert frame.count() > 0


def test_entry(spark, connection):
    frame = driver.entry(spark)
    assert differences(frame, connection, ORACLE["notional_per_minute"]) == []


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
