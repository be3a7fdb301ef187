"""Shapes the physical plans must keep: what is read, shuffled, and how."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tidegauge.operators import joins, rules

QUERIES = entry_points.queries()
BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def big(spark):
    """Plan as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_single_task_windows(spark, big, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    # a global aggregate ends in one partition after partial aggregation; rows never do
    if name not in ("periodic_watermark", "punctuated_watermark"):
        assert "SinglePartition" not in text


@pytest.mark.parametrize("name", ["hot_items", "hot_urls", "ad_blacklist", "ad_warning"])
def test_ranking_is_cut_before_the_exchange(spark, name):
    assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", plan(QUERIES[name](spark, SMALL)))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("hot_items", "ts,user_id"),
        ("page_view", "ts,event_type"),
        ("latest_per_key", "event_id,ts,user_id,value"),
        ("login_fail_pair", "event_id,ts,user_id,event_type"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(QUERIES[name](spark, SMALL)))
    assert scans
    for scan in scans:
        assert set(re.sub(r"#\d+L?", "", scan).split(",")) <= set(columns.split(","))


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(QUERIES["page_view"](spark, SMALL))


@pytest.mark.parametrize("name", ["running_reduce", "temp_jump", "order_pay", "rising_run", "login_fail_burst"])
def test_histories_are_windowed_by_key_and_slot(spark, big, name):
    """Rows are sorted per (key, slot); only the per-slot table is windowed by key alone."""
    text = plan(QUERIES[name](spark, SMALL))
    assert re.search(r"hashpartitioning\(user_id#\d+L, __slot", text)
    for line in text.splitlines():
        if re.search(r"\+- Window|: +Window", line) and "__slot" not in line:
            pytest.fail(line)


def test_rows_are_shuffled_once_for_runs(spark, big):
    """Both sides of the run join share one exchange of the rows."""
    df = rules.rising_run(
        spark.read.parquet(f"{SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")),
        "user_id",
        "ts",
        "value",
        "event_id",
    )
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_interval_join_is_an_equi_join_on_key_and_bucket(spark, big):
    rows = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    text = plan(joins.interval_join(rows, rows, ["user_id"], "ts", "ts"))
    assert re.search(r"SortMergeJoin \[__left_\w+#\d+L, __left_\w+#\d+L\]", text)
