"""Streaming queries over the event table, read as a file stream to its end.

Each run gets a checkpoint and output folder of its own in the shared checkpoint folder. A watermark
is set after the filter, so the rows a query looks at are the ones that move it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidegauge.functions.time import epoch_text
from tidegauge.operators import patterns as match
from tidegauge.operators import routing
from tidegauge.operators.windows import window_agg, with_event_time
from tidegauge.plans.queries import as_access_lines, as_text, marketing, of_type, query
from tidegauge.plans.tables import SCHEMAS
from tidegauge.session import SETTINGS, checkpoint_dir
from tidegauge.sinks.tables import read_table
from tidegauge.sources import parse
from tidegauge.streaming import patterns, rules, run, running, sliding, windows

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    # the pattern lets the table be one file or a folder of files
    return spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/{{events.parquet}}")


def timed(rows: DataFrame) -> DataFrame:
    return with_event_time(rows, "ts", "timestamp")


def finish(
    spark: SparkSession, name: str, start: Callable[[str, str], StreamingQuery], close: Callable[[], None] | None = None
) -> str:
    """Run a stream over all there is, and with ``close`` to its end; its output folder."""
    unique = f"{name}-{uuid.uuid4().hex}"
    out = f"{checkpoint_dir(spark)}/results/{unique}"
    start(unique, out).awaitTermination()
    if close:
        close()
        start(unique, out).awaitTermination()
    return out


def closing(rows: DataFrame, **values: str) -> tuple[DataFrame, Callable[[], None]]:
    folder = f"{checkpoint_dir(rows.sparkSession)}/closing/{uuid.uuid4().hex}"
    rows, close = run.closable(rows, "ts", folder, **values)
    return timed(rows), close


def written(
    rows: DataFrame, name: str, plan: Callable[[DataFrame], DataFrame], **values: str
) -> tuple[str, StructType]:
    """``plan`` over the stream ``rows`` and its closing row: output folder and schema."""
    rows, close = closing(rows, **values)
    df = plan(rows)
    out = finish(rows.sparkSession, name, lambda unique, path: run.to_parquet(df, unique, path, every=None), close)
    return out, df.schema


def stored(rows: DataFrame, name: str, plan: Callable[[DataFrame], DataFrame], **values: str) -> DataFrame:
    out, schema = written(rows, name, plan, **values)
    return rows.sparkSession.read.schema(schema).parquet(out)


@query
def stream_page_view(spark, sf_dir):
    def plan(views):
        return window_agg(views, "ts", "1 hour", pv=F.count(F.lit(1))).select("window_end", "pv")

    return stored(events(spark, sf_dir).where(of_type("view")), "page_view", plan)


@query
def stream_unique_visitor(spark, sf_dir):
    views = events(spark, sf_dir).where(of_type("view"))
    return stored(views, "unique_visitor", lambda df: windows.unique_count(df, "ts", "1 hour", "user_id"))


@query
def stream_uv_bitmap(spark, sf_dir):
    views = timed(events(spark, sf_dir).where(of_type("view")))
    pieces = windows.bitmap_pieces(views, "ts", "1 hour", "user_id")
    out = finish(
        spark,
        "uv_bitmap",
        lambda unique, path: run.to_upsert_table(
            pieces, unique, path, ["window_end", "piece"], ["bits"], ["bits"], 8, "update", None
        ),
    )
    return read_table(spark, out).groupBy("window_end").agg(F.sum("bits").alias("uv"))


@query
def stream_hot_items(spark, sf_dir):
    seen, close = closing(events(spark, sf_dir).select("ts", F.col("user_id").alias("item_id")))
    counts = window_agg(seen, "ts", "1 hour", "5 minutes", keys=["item_id"], count=F.count(F.lit(1)))
    out = finish(
        spark,
        "hot_items",
        lambda unique, path: run.top_n_to_parquet(
            counts.drop("window_start"), unique, path, "window_end", "count", "item_id", 3, None
        ),
        close,
    )
    return run.read_batches(spark, out).drop("batch")


@query
def stream_temp_jump(spark, sf_dir):
    def plan(rows):
        return rules.jump_alert(rows, "user_id", "ts", "value", "event_id", 10.0)

    return stored(events(spark, sf_dir), "temp_jump", plan).withColumnRenamed("seq", "event_id")


@query
def stream_login_fail_pair(spark, sf_dir):
    def plan(rows):
        return rules.fail_pair(rows, "user_id", "ts", "event_id", of_type("error"), "2 hours")

    return stored(events(spark, sf_dir), "login_fail_pair", plan)


def _clicks(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "ts", "user_id", F.col("event_type").alias("ad_id"))


def _blacklist(clicks):
    return rules.click_blacklist(clicks, ["user_id", "ad_id"], "ts", "event_id", 2)


@query
def stream_ad_blacklist(spark, sf_dir):
    return stored(_clicks(spark, sf_dir), "ad_blacklist", _blacklist)


@query
def stream_ad_by_geo(spark, sf_dir):
    """A second stream counts the clicks let through, from the files of the first. A batch of those
    holds rows that one move of the first watermark passed, so batches come in time order."""

    def plan(good):
        counts = sliding.sliding_count(good, "ts", "1 hour", "5 seconds", ["province"])
        return counts.select(epoch_text(F.col("window_end")).alias("window_end"), "province", "count")

    out, schema = written(_clicks(spark, sf_dir), "ad_clicks", _blacklist)
    good = spark.readStream.schema(schema).parquet(out).where("route = 'main'")
    return stored(good.select("ts", F.col("ad_id").alias("province")), "ad_by_geo", plan)


@query
def stream_hot_urls(spark, sf_dir):
    """Counts leave with each batch and rows late by up to a minute still correct them; each window keeps its three
    best, which later counts replace."""
    visits = routing.drop_static_urls(parse.parse_access_log(as_access_lines(events(spark, sf_dir))))
    visits = with_event_time(visits, "ts", "timestamp", delay="1 second", lateness="1 minute")
    counts = window_agg(visits, "ts", "1 hour", "5 minutes", keys=["url"], count=F.count(F.lit(1)))
    out = finish(
        spark,
        "hot_urls",
        lambda unique, path: run.refined_top_n(counts, unique, path, "window_end", "count", "url", 3, 8, None),
    )
    return read_table(spark, out).select("window_end", "url", "count", "rank")


@query
def stream_pay_match(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    pays, receipts = timed(rows.where(of_type("purchase"))), timed(rows.where(of_type("click")))
    pairs = windows.interval_join(pays, receipts, ["user_id"], "ts", "ts", "-30 minutes", "30 minutes")
    ids = pairs.select("user_id", F.col("left.event_id").alias("pay_id"), F.col("right.event_id").alias("receipt_id"))
    out = finish(spark, "pay_match", lambda unique, path: run.to_parquet(ids, unique, path, every=None))
    return spark.read.schema(ids.schema).parquet(out)


@query
def stream_pay_unmatched(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    (pays, end_pays), (receipts, end_receipts) = [closing(rows.where(of_type(kind))) for kind in ("purchase", "click")]
    outer = windows.interval_join(pays, receipts, ["user_id"], "ts", "ts", "-30 minutes", "30 minutes", "full_outer", "1 day")
    alone = outer.where("left is null or right is null").select(
        F.when(F.col("right").isNull(), "unmatched pay").otherwise("unmatched receipt").alias("kind"),
        "user_id",
        F.coalesce("left.event_id", "right.event_id").alias("event_id"),
    )

    def close():
        end_pays()
        end_receipts()

    out = finish(spark, "pay_unmatched", lambda unique, path: run.to_parquet(alone, unique, path, every=None), close)
    return spark.read.schema(alone.schema).parquet(out)


@query
def stream_latest_per_key(spark, sf_dir):
    rows = timed(events(spark, sf_dir).select("user_id", "event_id", "ts", "value"))
    out = finish(
        spark,
        "latest",
        lambda unique, path: run.to_upsert_table(
            rows, unique, path, ["user_id"], ["ts", "event_id"], ["value"], 8, "append", None
        ),
    )
    return read_table(spark, out).select("user_id", "value")


@query
def stream_login_fail_burst(spark, sf_dir):
    def plan(rows):
        return rules.fail_burst(rows, "user_id", "ts", "event_id", of_type("error"), "12 hours", 2)

    return stored(events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type"), "login_fail_burst", plan)


@query
def stream_order_sequence(spark, sf_dir):
    def plan(rows):
        found = patterns.followed_by(rows, ["user_id"], "ts", "event_id", of_type("signup"), of_type("purchase"), "12 hours")
        create, pay = F.col("first_seq").alias("create_id"), F.col("second_seq").alias("pay_id")
        return found.select("user_id", create, pay, "route")

    return stored(events(spark, sf_dir).where(of_type("signup") | of_type("purchase")), "order_sequence", plan, event_type="signup")


@query
def stream_order_warning(spark, sf_dir):
    def plan(rows):
        daily = rows.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
        return rules.order_warning(daily, ["user_id", "day"], "ts", "event_id", of_type("signup"), of_type("purchase"), "4 hours")

    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return stored(rows.where(of_type("signup") | of_type("purchase")), "order_warning", plan, event_type="signup")


@query
def stream_order_status(spark, sf_dir):
    """A user counts as one order, so it is remembered as long as the table lasts."""

    def plan(rows):
        signup, purchase = of_type("signup"), of_type("purchase")
        return rules.order_match(rows, ["user_id"], "ts", "event_id", signup, purchase, "72 hours", remember="36500 days")

    return stored(events(spark, sf_dir).where(of_type("signup") | of_type("purchase")), "order_status", plan, event_type="signup")


@query
def stream_sensor_min(spark, sf_dir):
    def plan(rows):
        lowest = sliding.sliding_min(rows, "ts", "15 hours", "5 hours", ["user_id"], "value", "min_value", "-8 hours")
        return lowest.drop("window_start")

    return stored(events(spark, sf_dir).select("user_id", "ts", "value"), "sensor_min", plan)


@query
def stream_fail_times(spark, sf_dir):
    """Three failures in a row, each the next event of the user."""

    def plan(rows):
        steps = match.times("fail", of_type("error"), 3)
        found = patterns.match_sequence(rows, ["user_id"], "ts", "event_id", steps, "72 hours")
        return found.select("user_id", *[F.col(f"{n}.event_id").alias(n) for n, _ in steps], "route")

    return stored(events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type"), "fail_times", plan)


@query
def stream_signup_path(spark, sf_dir):
    """A signup, the first click after it, and the first purchase after that."""

    def plan(rows):
        steps = [(n, of_type(n)) for n in ("signup", "click", "purchase")]
        found = patterns.match_sequence(rows, ["user_id"], "ts", "event_id", steps, "48 hours", match.FOLLOWED_BY)
        return found.select("user_id", *[F.col(f"{n}.event_id").alias(n) for n, _ in steps], "route")

    return stored(events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type"), "signup_path", plan, event_type="signup")


@query
def stream_channel_count(spark, sf_dir):
    def plan(rows):
        return as_text(sliding.sliding_count(marketing(rows), "ts", "1 hour", "10 seconds", ["channel", "behavior"]))

    rows = events(spark, sf_dir).select("ts", "event_type", "props")
    return stored(rows, "channel_count", plan, event_type="view", props='{"k": 0}')


@query
def stream_word_sum(spark, sf_dir):
    def plan(rows):
        return running.running_sum(rows, ["word"], "ts", "event_id", F.lit(1), "n").drop("ts")

    return stored(events(spark, sf_dir).select("ts", "event_id", F.col("event_type").alias("word")), "word_sum", plan)


@query
def stream_value_sum(spark, sf_dir):
    def plan(rows):
        summed = running.running_sum(rows, ["user_id"], "ts", "event_id", F.col("value").cast("decimal(18,2)"), scale=2)
        return summed.select("event_id", "user_id", F.col("running").cast("double").alias("running"))

    return stored(events(spark, sf_dir).select("user_id", "ts", "event_id", "value"), "value_sum", plan)


@query
def stream_running_reduce(spark, sf_dir):
    def plan(rows):
        return running.running_reduce(rows, "user_id", "ts", "value", "event_id")

    return stored(events(spark, sf_dir).select("user_id", "ts", "event_id", "value"), "running_reduce", plan)


@query
def stream_uv_running(spark, sf_dir):
    def plan(views):
        return running.running_unique(views, "ts", "1 hour", "user_id", "event_id").withColumnRenamed("seq", "event_id")

    return stored(events(spark, sf_dir).where(of_type("view")), "uv_running", plan)
