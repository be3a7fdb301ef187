"""Every registered query against DuckDB on the smallest tables."""

import pytest
from compare import assert_same, connect
from conftest import SMALL

import __spark_entry__ as entry_points
from tidegauge.plans.oracle import ORACLE
from tidegauge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["item_id", "window_end", "count", "rank"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert assert_same(entry_points.queries()[name](spark, SMALL), duck, entry_points.oracle_sql()[name]) > 0
