"""Distinct users per window: exact, by bitmap, approximate, and as a running count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.hashing import BITMAP_BITS, masked_hash
from tidegauge.functions.time import bucket_start, micros
from tidegauge.operators.timeline import SLOT, carry_over, in_slot, with_slot
from tidegauge.operators.windows import event_window


def unique_count(
    df: DataFrame, ts: str, size: str, user: str, method: str = "exact", bits: int = BITMAP_BITS
) -> DataFrame:
    """``(window_end, uv)`` per tumbling window.

    ``exact``   Spark removes duplicates per (window, user) before and after the exchange and then
                counts, so no set of users is ever held for a window.
    ``bitmap``  One bit per hashed id, in fixed 4 KB pieces of 32,768 bits keyed by (window, piece);
                partial bitmaps merge on the map side and popcounts add up. Ids with equal hashes
                count once, so counts near 2^``bits`` come out too low.
    ``approx``  HyperLogLog++ sketch per window.

    Null users are not counted.
    """
    windowed = df.withColumn("window", event_window(ts, size))
    if method == "exact":
        counted = windowed.groupBy("window").agg(F.countDistinct(user).alias("uv"))
    elif method == "approx":
        counted = windowed.groupBy("window").agg(F.approx_count_distinct(user, 0.01).alias("uv"))
    elif method == "bitmap":
        pieces = (
            windowed.select("window", masked_hash(F.col(user), bits=bits).alias("h"))
            .groupBy("window", F.bitmap_bucket_number("h").alias("piece"))
            .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("h"))).alias("bits"))
        )
        counted = pieces.groupBy("window").agg(F.sum("bits").alias("uv"))
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(F.col("window.end").alias("window_end"), "uv")


def running_unique(
    df: DataFrame, ts: str, size: str, user: str, seq: str, slot: str = "1 minute", bits: int = BITMAP_BITS
) -> DataFrame:
    """For every event the count of distinct hashed users in its window so far; null users count nothing.

    Only a user's first event in a window raises the count. Those first events come from an
    aggregate (hot users shrink on the map side), join the stream of events as +1 marks, and a
    running sum over (window, slot) plus the carried total of earlier slots gives the answer.
    """
    width = micros(size)
    events = df.select(
        F.col(ts).alias("ts"),
        F.col(seq).alias("seq"),
        bucket_start(F.col(ts), width).alias("start"),
        masked_hash(F.col(user), bits=bits).alias("h"),
    )
    first = events.where("h is not null").groupBy("start", "h").agg(F.min(F.struct("ts", "seq")).alias("at"))
    marks = first.select("at.ts", "at.seq", "start", F.lit(1).alias("mark"))
    line = with_slot(events.select("ts", "seq", "start", F.lit(0).alias("mark")).unionByName(marks), "ts", slot)
    order = in_slot(["start"], F.col("ts"), F.col("seq"), F.col("mark").desc())
    local = line.withColumn("__n", F.sum("mark").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    total = carry_over(
        local,
        ["start"],
        {"__marks": F.sum("mark")},
        lambda per_slot, earlier: per_slot.select("start", SLOT, F.sum("__marks").over(earlier).alias("__prior")),
    )
    return total.where("mark = 0").select(
        "seq",
        F.timestamp_micros(F.col("start") + width).alias("window_end"),
        (F.col("__n") + F.coalesce("__prior", F.lit(0))).alias("uv"),
    )
