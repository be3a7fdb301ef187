"""One query per operator over the driver's tables.

The event table stands in for each kind of stream: ``user_id`` is the item, sensor, account or
order, ``event_type`` the behaviour, and ``value`` the reading. Where the streams' limits are
seconds, the sparser events use hours.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.hashing import masked_hash
from tidegauge.functions.time import epoch_text, next_midnight
from tidegauge.operators import aggregates, distinct, joins, orders, patterns, ranking, routing, rules, running, windows
from tidegauge.plans.tables import events, load, zone_free
from tidegauge.sinks.files import documents, labelled, tuple_text
from tidegauge.sinks.kafka import kafka_payload
from tidegauge.sources import parse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: zone_free(fn(spark, sf_dir))
    return fn


def of_type(kind: str):
    return F.col("event_type") == kind


# ---- hot items, hot pages -------------------------------------------------------------------


def _hot(counts: DataFrame, key: str) -> DataFrame:
    return ranking.top_n(counts.drop("window_start"), "window_end", "count", key, 3)


@query
def hot_items(spark, sf_dir):
    seen = events(spark, sf_dir).select("ts", F.col("user_id").alias("item_id"))
    return _hot(windows.sliding_count(seen, "ts", "1 hour", "5 minutes", ["item_id"]), "item_id")


@query
def hot_items_report(spark, sf_dir):
    seen = events(spark, sf_dir).select("ts", F.col("user_id").alias("item_id"))
    top = _hot(windows.sliding_count(seen, "ts", "1 hour", "5 minutes", ["item_id"]), "item_id")
    return ranking.report_text(top, "window_end", "count", "item_id")


# request paths by ``k % 10``; some are static files or the root
PATHS = ("/static/{k}.css", "/favicon.ico", "/img/{k}.png", "/") + ("/{type}/{k}",) * 6


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written as access-log lines."""
    return as_access_lines(events(spark, sf_dir))


def as_access_lines(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    path = F.element_at(F.array(*[F.lit(p) for p in PATHS]), F.col("k") % len(PATHS) + 1)
    path = F.replace(F.replace(path, F.lit("{k}"), F.col("k").cast("string")), F.lit("{type}"), F.col("event_type"))
    user = F.col("user_id").cast("string")
    return rows.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")),
            user,
            F.lit("-"),
            F.date_format("ts", parse.ACCESS_LOG_TIME),
            F.lit("+0000"),
            F.when(of_type("purchase"), "POST").otherwise("GET"),
            path,
        ).alias("value")
    )


@query
def parse_log(spark, sf_dir):
    return parse.parse_access_log(access_lines(spark, sf_dir))


@query
def hot_urls(spark, sf_dir):
    visits = routing.drop_static_urls(parse.parse_access_log(access_lines(spark, sf_dir)))
    return _hot(windows.sliding_count(visits, "ts", "1 hour", "5 minutes", ["url"]), "url")


@query
def hot_urls_report(spark, sf_dir):
    visits = routing.drop_static_urls(parse.parse_access_log(access_lines(spark, sf_dir)))
    top = _hot(windows.sliding_count(visits, "ts", "1 hour", "5 minutes", ["url"]), "url")
    return ranking.report_text(top, "window_end", "count", "url", ranking.URL_LABEL)


@query
def page_urls(spark, sf_dir):
    paths = load(spark, sf_dir, "pages").select("page_id", F.expr("parse_url(url, 'PATH')").alias("url"))
    return routing.drop_static_urls(paths)


# ---- page views and visitors ----------------------------------------------------------------


@query
def page_view(spark, sf_dir):
    views = events(spark, sf_dir).where(of_type("view"))
    counted = windows.window_agg(views, "ts", "1 hour", pv=F.count(F.lit(1)))
    return counted.select("window_end", F.lit("pv").alias("kind"), "pv")


@query
def keyed_hour_count(spark, sf_dir):
    counted = windows.window_agg(events(spark, sf_dir), "ts", "1 hour", keys=["event_type"], n=F.count(F.lit(1)))
    return counted.select("event_type", "window_start", "window_end", "n")


@query
def unique_visitor(spark, sf_dir):
    return distinct.unique_count(events(spark, sf_dir).where(of_type("view")), "ts", "1 hour", "user_id")


@query
def uv_bitmap(spark, sf_dir):
    return distinct.unique_count(events(spark, sf_dir).where(of_type("view")), "ts", "1 hour", "user_id", "bitmap")


@query
def uv_running(spark, sf_dir):
    views = events(spark, sf_dir).where(of_type("view"))
    return distinct.running_unique(views, "ts", "1 hour", "user_id", "event_id").withColumnRenamed("seq", "event_id")


# ---- marketing and advertising --------------------------------------------------------------

# fixed values: channel names
CHANNELS = ("google store", "facebook", "apple store", "wechat", "webo")


def marketing(rows: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), k % len(CHANNELS) + 1)
    return rows.where(~of_type("error")).select("ts", channel.alias("channel"), F.col("event_type").alias("behavior"))


def as_text(counts: DataFrame) -> DataFrame:
    return counts.withColumns({c: epoch_text(F.col(c)) for c in ("window_start", "window_end")})


@query
def channel_count(spark, sf_dir):
    return as_text(windows.sliding_count(marketing(events(spark, sf_dir)), "ts", "1 hour", "10 seconds", ["channel", "behavior"]))


@query
def market_total(spark, sf_dir):
    total = as_text(windows.sliding_count(marketing(events(spark, sf_dir)), "ts", "1 hour", "10 seconds"))
    return total.select(
        "window_start", "window_end", F.lit("app marketing").alias("channel"), F.lit("total").alias("behavior"), "count"
    )


def _clicks(spark, sf_dir):
    clicks = events(spark, sf_dir).select("event_id", "ts", "user_id", F.col("event_type").alias("ad_id"))
    return rules.click_blacklist(clicks, ["user_id", "ad_id"], "ts", "event_id", max_count=2)


@query
def ad_blacklist(spark, sf_dir):
    return _clicks(spark, sf_dir).where("route = 'main'").drop("route")


@query
def ad_warning(spark, sf_dir):
    return rules.blacklist_warnings(_clicks(spark, sf_dir), ["user_id", "ad_id"], 2)


@query
def ad_warning_month(spark, sf_dir):
    clicks = events(spark, sf_dir).select("event_id", "ts", "user_id", F.col("event_type").alias("ad_id"))
    routed = rules.click_blacklist(clicks, ["user_id", "ad_id"], "ts", "event_id", max_count=8, period=None)
    return routed.where("route = 'warning'").drop("route")


@query
def ad_by_geo(spark, sf_dir):
    good = _clicks(spark, sf_dir).where("route = 'main'").select("ts", F.col("ad_id").alias("province"))
    counted = windows.sliding_count(good, "ts", "1 hour", "5 seconds", ["province"])
    return counted.select(epoch_text(F.col("window_end")).alias("window_end"), "province", "count")


# ---- sensor readings ------------------------------------------------------------------------


@query
def sensor_min_window(spark, sf_dir):
    lowest = windows.sliding_agg(
        events(spark, sf_dir), "ts", "15 hours", "5 hours", ["user_id"], "-8 hours", min_value=("min", "value")
    )
    return lowest.drop("window_start")


@query
def running_reduce(spark, sf_dir):
    return running.running_reduce(events(spark, sf_dir), "user_id", "ts", "value", "event_id")


@query
def running_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    summed = running.running_sum(rows, ["user_id"], "ts", "event_id", F.col("value").cast("decimal(18,2)"))
    return summed.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query
def running_word_sum(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_type").alias("word"), "ts", "event_id")
    return running.running_sum(rows, ["word"], "ts", "event_id", F.lit(1), "n").drop("ts")


@query
def avg_int_div(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", F.unix_seconds("ts").alias("seconds"))
    return aggregates.avg_int_div(rows, ["user_id"], "seconds")


@query
def temp_jump(spark, sf_dir):
    return rules.jump_alert(events(spark, sf_dir), "user_id", "ts", "value", "event_id", 10.0)


@query
def temp_jump_zero(spark, sf_dir):
    return rules.jump_alert(events(spark, sf_dir), "user_id", "ts", "value", "event_id", 10.0, first_as_zero=True)


@query
def rising_run(spark, sf_dir):
    return rules.rising_run(events(spark, sf_dir), "user_id", "ts", "value", "event_id", "10 hours")


# ---- logins and orders ----------------------------------------------------------------------


@query
def login_fail_pair(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    return rules.fail_pair(rows, "user_id", "ts", "event_id", of_type("error"), "2 hours")


@query
def login_fail_burst(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    return rules.fail_burst(rows, "user_id", "ts", "event_id", of_type("error"), "12 hours", 2)


def _orders(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    return patterns.match_sequence(
        rows,
        ["user_id"],
        "ts",
        "event_id",
        [("create", of_type("signup")), ("pay", of_type("purchase"))],
        "12 hours",
        patterns.FOLLOWED_BY,
        columns=["event_id", "ts"],
    )


@query
def order_pay(spark, sf_dir):
    return _orders(spark, sf_dir).where("route = 'match'").select(
        "user_id",
        F.col("create.event_id").alias("create_id"),
        F.col("pay.event_id").alias("pay_id"),
        F.lit("order paid in time").alias("msg"),
    )


@query
def order_timeout(spark, sf_dir):
    return _orders(spark, sf_dir).where("route = 'timeout'").select(
        "user_id", F.col("create.event_id").alias("create_id"), F.lit("timeout").alias("msg")
    )


@query
def three_step_sequence(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    steps = [("view", of_type("view")), ("click", of_type("click")), ("buy", of_type("purchase"))]
    found = patterns.match_sequence(
        rows, ["user_id"], "ts", "event_id", steps, "36 hours", patterns.FOLLOWED_BY, columns=["event_id", "ts"]
    )
    return found.select(
        "user_id",
        *[F.col(f"{s}.event_id").alias(f"{s}_id") for s, _ in steps],
        "route",
    )


@query
def login_fail_times(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    steps = patterns.times("fail", of_type("error"), 3)
    found = patterns.match_sequence(rows, ["user_id"], "ts", "event_id", steps, "7 days", columns=["event_id", "ts"])
    return found.where("route = 'match'").select(
        "user_id", F.col("fail1.event_id").alias("first_id"), F.col("fail3.event_id").alias("last_id")
    )


def _daily_orders(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_type")


@query
def order_status(spark, sf_dir):
    return orders.order_match(
        _daily_orders(spark, sf_dir), ["user_id", "day"], "ts", of_type("signup"), of_type("purchase"), "4 hours"
    )


@query
def order_paid_warning(spark, sf_dir):
    return orders.order_warning(
        _daily_orders(spark, sf_dir), ["user_id", "day"], "ts", of_type("signup"), of_type("purchase"), "4 hours"
    )


def _pays_and_receipts(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return rows.where(of_type("purchase")).drop("event_type"), rows.where(of_type("click")).drop("event_type")


@query
def signup_paths(spark, sf_dir):
    """Every click and every later purchase within two days of a signup, not just the first ones."""
    steps = [(n, of_type(n)) for n in ("signup", "click", "purchase")]
    rows = events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type")
    found = patterns.match_any(rows, ["user_id"], "ts", "event_id", steps, "48 hours", ["event_id"])
    return found.select("user_id", *[F.col(f"{n}.event_id").alias(n) for n, _ in steps])


@query
def pay_match(spark, sf_dir):
    pays, receipts = _pays_and_receipts(spark, sf_dir)
    pairs = joins.interval_join(pays, receipts, ["user_id"], "ts", "ts", "-30 minutes", "30 minutes")
    return pairs.select("user_id", F.col("left.event_id").alias("pay_id"), F.col("right.event_id").alias("receipt_id"))


@query
def pay_match_ids(spark, sf_dir):
    """Payments and receipts by transaction id; those without one match nothing."""
    known = F.get_json_object("props", "$.k").cast("int") % 5 != 0
    trx = F.when(known, F.concat(F.lit("t"), F.col("user_id").cast("string"))).otherwise("")
    rows = routing.drop_empty(events(spark, sf_dir).select("event_id", "ts", "event_type", trx.alias("trx_id")), "trx_id")
    pays, receipts = [rows.where(of_type(kind)).drop("event_type") for kind in ("purchase", "click")]
    pairs = joins.interval_join(pays, receipts, ["trx_id"], "ts", "ts", "-6 hours", "6 hours")
    return pairs.select("trx_id", F.col("left.event_id").alias("pay_id"), F.col("right.event_id").alias("receipt_id"))


@query
def pay_unmatched(spark, sf_dir):
    pays, receipts = _pays_and_receipts(spark, sf_dir)
    outer = joins.interval_join(pays, receipts, ["user_id"], "ts", "ts", "-30 minutes", "30 minutes", "full_outer")
    alone = outer.where("left is null or right is null")
    return alone.select(
        F.when(F.col("right").isNull(), "unmatched pay").otherwise("unmatched receipt").alias("kind"),
        "user_id",
        F.coalesce("left.event_id", "right.event_id").alias("event_id"),
    )


# ---- routing and parsing --------------------------------------------------------------------


def _split(spark, sf_dir):
    high = F.col("value") > 30
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    return routing.route(rows, {"high30": high, "low30": ~high})


@query
def split_streams(spark, sf_dir):
    routed = _split(spark, sf_dir)
    return routed.select("event_id", "value", F.array_join("routes", ",").alias("routes"))


@query
def union_streams(spark, sf_dir):
    routed = _split(spark, sf_dir)
    high, low = routing.select_routes(routed, "high30"), routing.select_routes(routed, "low30")
    return routing.union_all(high, low, high)


@query
def comap_union(spark, sf_dir):
    routed = _split(spark, sf_dir)
    return routing.co_map(
        routing.select_routes(routed, "high30"),
        routing.select_routes(routed, "low30"),
        lambda high: high.select("user_id", "value", F.lit("warning").alias("state")),
        lambda low: low.select("user_id", F.lit("healthy").alias("state")),
    )


@query
def freezing_alert(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "user_id", "value")
    text = F.concat(F.lit("freezing alert for "), F.col("user_id").cast("string"))
    return routing.side_output(rows, F.col("value") < 32.0, text)


@query
def prefix_filter(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.concat(F.lit("s_"), F.col("user_id").cast("string")).alias("id"))
    return rows.where(F.col("id").startswith("s_1"))


@query
def partition_map(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type")

    def label(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": batch["event_id"], "label": batch["event_type"].str.upper()})

    return routing.map_partitions(rows, label, "event_id long, label string")


@query
def word_count(spark, sf_dir):
    return aggregates.word_count(load(spark, sf_dir, "documents"), "text")


@query
def word_count_nonempty(spark, sf_dir):
    return aggregates.word_count(load(spark, sf_dir, "documents"), "text", keep_empty=False)


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return events(spark, sf_dir).select(
        F.concat_ws(
            ", ",
            F.col("user_id").cast("string"),
            F.col("event_id").cast("string"),
            k,
            "event_type",
            F.unix_seconds("ts").cast("string"),
        ).alias("value")
    )


@query
def parse_events(spark, sf_dir):
    return parse.parse_delimited(behavior_lines(spark, sf_dir), parse.USER_BEHAVIOR)


@query
def parse_quarantine(spark, sf_dir):
    lines = events(spark, sf_dir).select(
        F.concat_ws(
            ",",
            F.concat(F.lit("s_"), F.col("user_id").cast("string")),
            F.when(of_type("error"), "n/a").otherwise(F.unix_seconds("ts").cast("string")),
            F.when(~of_type("signup"), F.col("event_id").cast("string")),
        ).alias("value")
    )
    return parse.parse_delimited(lines, parse.SENSOR, mode="lenient")


# ---- time, scalar functions, sink payloads --------------------------------------------------


@query
def periodic_watermark(spark, sf_dir):
    return windows.watermark_at(events(spark, sf_dir), "ts", "60 seconds")


@query
def punctuated_watermark(spark, sf_dir):
    return windows.watermark_at(events(spark, sf_dir), "ts", "60 seconds", F.col("user_id") == 1)


@query
def scalar_functions(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        masked_hash(F.col("user_id")).alias("hash"),
        epoch_text(F.date_trunc("second", "ts")).alias("text_time"),
        next_midnight(F.col("ts")).alias("resets_at"),
        F.abs(F.col("value") - 100).alias("distance"),
        F.col("event_type").rlike("^(click|view)$").alias("is_visit"),
        F.col("event_type").endswith("up").alias("ends_up"),
    )


@query
def latest_per_key(spark, sf_dir):
    return aggregates.latest_per_key(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["value"])


@query
def sensor_documents(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "value", F.unix_seconds("ts").alias("seconds"))
    return documents(rows, {"sensor_id": "user_id", "temperature": "value", "ts": "seconds"})


@query
def topic_records(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", F.unix_seconds("ts").alias("seconds"), "value")
    return kafka_payload(rows, "user_id", name="SensorReading")


@query
def text_records(spark, sf_dir):
    counted = events(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return labelled(tuple_text(counted), "word count")
