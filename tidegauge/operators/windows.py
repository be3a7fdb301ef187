"""Tumbling and sliding event-time windows, half-open and aligned to the epoch plus an offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import bucket_start, event_time, floor_micros, interval, micros


def with_event_time(
    df: DataFrame,
    col: str,
    unit: str = "seconds",
    delay: str = "1 millisecond",
    lateness: str = "0 seconds",
    name: str = "ts",
) -> DataFrame:
    """Event-time column plus a watermark of ``delay`` (disorder bound) and ``lateness`` (grace).

    The default suits rows that arrive in time order: a row is late only when older than the newest
    one seen, where Spark with no delay at all would drop a later batch's row of equal time.

    On a batch DataFrame the watermark has no effect. On a stream in append mode a window is
    emitted once, after delay and lateness; in update mode late rows inside the grace refine it.
    """
    timed = df.withColumn(name, event_time(F.col(col), unit))
    return timed.withWatermark(name, interval(micros(delay) + micros(lateness)))


def punctuated_marker(df: DataFrame, ts: str, condition: Column, name: str = "marker_ts") -> DataFrame:
    """Event time only on the rows allowed to advance the watermark, null elsewhere."""
    return df.withColumn(name, F.when(condition, F.col(ts)))


def watermark_at(df: DataFrame, ts: str, delay: str, condition: Column | None = None) -> DataFrame:
    """The final watermark of a bounded input: latest (marker) time minus ``delay``, one row."""
    marked = df if condition is None else df.where(condition)
    return marked.agg(
        F.timestamp_micros(F.max(F.unix_micros(F.col(ts))) - F.lit(micros(delay))).alias("watermark")
    )


def event_window(ts: str, size: str, slide: str | None = None, offset: str | None = None) -> Column:
    """``F.window`` with any offset; Spark wants a start below the slide, so it is reduced first."""
    step = micros(slide or size)
    start = micros(offset) % step if offset else 0
    return F.window(F.col(ts), interval(micros(size)), interval(step), interval(start))


def window_agg(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str | None = None,
    offset: str | None = None,
    keys: Sequence[str] = (),
    **aggs: Column,
) -> DataFrame:
    """Any aggregates per window and key, in batch and on streams.

    A sliding window copies each row ``size / slide`` times before the partial aggregate. In batch
    prefer ``sliding_agg`` or ``sliding_count``, which copy aggregated panes instead.
    """
    return (
        df.groupBy(event_window(ts, size, slide, offset).alias("window"), *keys)
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *aggs,
        )
    )


_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def sliding_agg(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    offset: str | None = None,
    **aggs: tuple[str, str],
) -> DataFrame:
    """Batch sliding ``count``, ``sum``, ``min`` or ``max``; ``aggs`` maps name -> (kind, column).

    Rows fold into panes of one slide first (partial aggregate, one copy of each row), then each
    pane is copied to the windows it belongs to and panes merge.
    """
    width, step = micros(size), micros(slide)
    if width % step:
        raise ValueError("size must be a multiple of slide")
    base = micros(offset) % step if offset else 0
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    panes = df.groupBy(*keys, bucket_start(F.col(ts), step, base).alias("pane")).agg(
        *[first[kind](F.col(col)).alias(name) for name, (kind, col) in aggs.items()]
    )
    starts = F.sequence(F.col("pane") - (width - step), F.col("pane"), F.lit(step))
    return (
        panes.withColumn("start", F.explode(starts))
        .groupBy(*keys, "start")
        .agg(*[_MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()])
        .select(
            *keys,
            F.timestamp_micros("start").alias("window_start"),
            F.timestamp_micros(F.col("start") + width).alias("window_end"),
            *aggs,
        )
    )


def sliding_count(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str,
    keys: Sequence[str] = (),
    offset: str | None = None,
    chunk: str = "1 day",
) -> DataFrame:
    """Batch rows per sliding window and key, without copying rows per window.

    A pane of ``c`` rows raises the count by ``c`` at the first window it falls into and lowers it
    where it leaves, so the count is a running sum of changes and every gap between changes is
    filled by ``sequence``. For one hour by five seconds native windows copy each row 720 times;
    here rows fold into panes and a pane makes two or three changes.

    The running sum is cut into ``chunk``-long pieces of the calendar. A pane still open at a chunk
    border re-enters the next chunk as a change at its start, so no piece needs another one and no
    task sees more than one chunk of one key, ``chunk / slide`` rows.
    """
    width, step = micros(size), micros(slide)
    if width % step:
        raise ValueError("size must be a multiple of slide")
    base = micros(offset) % step if offset else 0
    span = max(width, micros(chunk)) // step * step

    panes = df.groupBy(*keys, bucket_start(F.col(ts), step, base).alias("pane")).agg(F.count(F.lit(1)).alias("c"))
    enter, leave = F.col("pane") + step, F.col("pane") + step + width
    enter_chunk, leave_chunk = floor_micros(enter, span, base), floor_micros(leave, span, base)

    def change(piece: Column, at: Column, amount: Column) -> Column:
        return F.struct(piece.alias("piece"), at.alias("at"), amount.alias("d"))

    gain, loss = F.col("c"), -F.col("c")
    changes = F.when(
        enter_chunk == leave_chunk,
        F.array(change(enter_chunk, enter, gain), change(leave_chunk, leave, loss)),
    ).otherwise(
        F.array(
            change(enter_chunk, enter, gain),
            change(leave_chunk, leave_chunk, gain),
            change(leave_chunk, leave, loss),
        )
    )
    # One exchange on (key, piece) serves the aggregate and the window after it. Its number of
    # partitions is explicit: adaptive coalescing goes by input size and would merge small pieces
    # that the last step expands into many windows.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = (
        panes.select(*keys, F.inline(changes))
        .repartition(partitions, *keys, "piece")
        .groupBy(*keys, "piece", "at")
        .agg(F.sum("d").alias("d"))
    )
    along = Window.partitionBy(*keys, "piece").orderBy("at")
    running = F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0))
    until = F.coalesce(F.lead("at").over(along), F.col("piece") + span)
    return (
        steps.select(*keys, "at", until.alias("until"), running.alias("count"))
        .where("count > 0")
        .select(*keys, F.explode(F.sequence("at", F.col("until") - step, F.lit(step))).alias("end"), "count")
        .select(
            *keys,
            F.timestamp_micros(F.col("end") - width).alias("window_start"),
            F.timestamp_micros("end").alias("window_end"),
            "count",
        )
    )
