"""Every registered query against its DuckDB oracle."""

import os

import pytest

import __spark_entry__ as driver
from verification.check import connect, differences

SF_DIR = os.environ.get("TOUCHLINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(driver.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert differences(driver.queries()[name](spark, SF_DIR), duck, driver.oracle_sql()[name]) == []


def test_every_query_has_an_oracle():
    assert set(driver.QUERIES) == set(driver.ORACLES)


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns == ["Nombre"]
    assert driver.entry(spark).count() > 0
