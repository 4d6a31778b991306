"""Every query with a SQL text gives the same columns, types and values as DuckDB."""

import pytest
from check import differences, duck
from places import STAR

from larkspur.catalog import QUERIES
from larkspur.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(STAR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(spark, con, name, STAR) == []


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_driver_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
