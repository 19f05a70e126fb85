"""Every checked query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.base import ORACLES, QUERIES
from checks.compare import compare, duck


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, sf, name):
    good, note = compare(spark, connection, name, sf)
    assert good, note


def test_every_query_has_sql():
    # An approximate answer has none; its recall is measured in test_neighbours.
    assert set(QUERIES) - set(ORACLES) == {"nearest_index"} and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())


def test_flagship_query(spark):
    assert driver.entry(spark).columns == ["timestamp", "id", "value", "type"]
