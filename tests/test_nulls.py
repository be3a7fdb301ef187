"""Null keys, users, readings and flags, and the slot width, which must not change answers."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import aggregates, distinct, routing, rules, running

BEGIN = datetime(2024, 1, 1)
SLOTS = ["1 second", "10 minutes", "1 day"]


def rows(spark, values, key="a", hours=1):
    data = [(i, BEGIN + timedelta(hours=i * hours), key, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "seq long, ts timestamp, key string, value double")


@pytest.mark.parametrize("slot", SLOTS)
def test_a_null_reading_ends_a_rising_run(spark, slot):
    df = rows(spark, [5.0, None, 3.0, 4.0])
    found = rules.rising_run(df, "key", "ts", "value", "seq", slot=slot).collect()
    assert [(r.first_value, r.last_value, r.readings) for r in found] == [(3.0, 4.0, 2)]


@pytest.mark.parametrize("slot", SLOTS)
def test_rows_without_key_have_no_running_sum(spark, slot):
    df = rows(spark, [1.0, 1.0], None).union(rows(spark, [1.0, 2.0]))
    found = running.running_sum(df, ["key"], "ts", "seq", F.col("value"), slot=slot).collect()
    assert sorted(r.running for r in found) == [1.0, 3.0]


def test_null_users_are_not_counted(spark):
    df = rows(spark, [None, None], None, 0).union(rows(spark, [1.0], "u", 0))
    for method in ("exact", "bitmap", "approx"):
        assert distinct.unique_count(df, "ts", "1 hour", "key", method).collect()[0].uv == 1
    assert max(r.uv for r in distinct.running_unique(df, "ts", "1 hour", "key", "seq").collect()) == 1


def test_a_long_average_does_not_overflow(spark):
    df = spark.createDataFrame([("a", (1 << 63) - 1)] * 3, "key string, n long")
    assert aggregates.avg_int_div(df, ["key"], "n").collect()[0].average == float((1 << 63) - 1)


def test_the_opened_resource_reaches_the_function(spark):
    df = routing.map_partitions(spark.range(3), lambda f, k: f.assign(id=f["id"] + k), "id long", lambda: 10)
    assert sorted(r.id for r in df.collect()) == [10, 11, 12]


@pytest.mark.parametrize("slot", SLOTS)
def test_a_null_reading_raises_no_jump_alert(spark, slot):
    df = rows(spark, [50.0, 10.0, None, 90.0]).union(rows(spark, [1.0, 90.0], None))
    found = rules.jump_alert(df, "key", "ts", "value", "seq", slot=slot).collect()
    assert [(r.last_value, r.value) for r in found] == [(50.0, 10.0)]
    first = rules.jump_alert(df, "key", "ts", "value", "seq", first_as_zero=True, slot=slot).collect()
    assert sorted((r.last_value, r.value) for r in first) == [(0.0, 50.0), (50.0, 10.0)]
