"""Training-data queries that have SQL against it on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import differences, oracle_connection


@pytest.mark.parametrize("name", sorted(driver.LLM_ORACLE))
def test_query(spark, name):
    frame = driver.queries()[name](spark, driver.SMOKE_DIR)
    assert differences(frame, oracle_connection(driver.SMOKE_DIR), driver.oracle_sql()[name]) == []
    assert frame.count() > 0
