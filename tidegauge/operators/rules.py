"""Keyed rules in batch form. Results depend on event time only, never on arrival order."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import floor_micros, micros
from tidegauge.operators.patterns import match_sequence
from tidegauge.operators.timeline import DEFAULT_SLOT, SLOT, carry_last, in_slot, islands, on_timeline, with_slot

# fixed values: wording of the warnings
RISING_TEXT = "温度连续上升告警!"


def rising_run(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    seq: str,
    span: str = "10 seconds",
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Runs of rising values that last at least ``span`` of event time, one row per run.

    A reading that does not exceed the one before begins a new run, as does one next to a null reading;
    a run needs two readings.
    """
    runs = islands(
        df, [key], ts, seq, F.struct(F.col(value).alias("__v")), lambda p, c: F.coalesce(c["__v"] <= p["__v"], F.lit(True)), slot
    )
    grouped = runs.groupBy(key, "run_start").agg(
        F.max(F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"), F.col("__v").alias("v"))).alias("end"),
        F.min("__v").alias("first_value"),
        F.count(F.lit(1)).alias("readings"),
    )
    lasted = F.unix_micros("end.ts") - F.unix_micros("run_start.ts")
    return grouped.where((F.col("readings") >= 2) & (lasted >= micros(span))).select(
        key,
        F.col("run_start.ts").alias("run_start"),
        F.col("end.ts").alias("run_end"),
        "first_value",
        F.col("end.v").alias("last_value"),
        "readings",
        F.concat(F.col(key).cast("string"), F.lit(RISING_TEXT)).alias("msg"),
    )


def jump_alert(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    seq: str,
    threshold: float = 10.0,
    first_as_zero: bool = False,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Readings differing from the one before by more than ``threshold``: (key, last, current).

    ``first_as_zero`` compares a key's first reading with 0.0 instead of passing it. A null reading
    raises no alert, nor does the one after it; rows without key or time take no part.
    """
    base = with_slot(on_timeline(df.select(key, ts, value, seq), [key], ts), ts, slot)
    # in a struct, so that a null reading is not taken for no reading
    reading = F.struct(F.col(value).alias("v"))
    local = base.withColumn("__prev", F.lag(reading).over(in_slot([key], F.col(ts), F.col(seq))))
    joined = carry_last(local, [key], "__before", reading, F.struct(ts, seq))
    zero = F.struct(F.lit(0).cast(df.schema[value].dataType).alias("v"))
    last = F.coalesce("__prev", "__before", *([zero] if first_as_zero else []))["v"]
    return (
        joined.withColumn("last_value", last)
        .where(F.abs(F.col(value) - F.col("last_value")) > threshold)
        .select(key, seq, "last_value", F.col(value).alias("value"))
    )


def click_blacklist(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    max_count: int = 100,
    period: str | None = "day",
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Route clicks: the first ``max_count`` per key and period are ``main``, the next one is the
    ``warning``, the rest is dropped. ``period`` is ``day`` (counters restart at midnight of event
    time) or None.

    Ranking runs twice, first inside slots. What may matter from a slot is its first
    ``max_count + 1`` clicks, so the second ranking sees a bounded number of rows per key and
    period whatever the key's share of the clicks.
    """
    if period not in ("day", None):
        raise ValueError(f"unknown period {period!r}")
    keep = max_count + 1
    day = F.date_trunc("day", F.col(ts)) if period else F.lit(0)
    base = with_slot(df, ts, slot).withColumn("__period", day)
    arrival = [F.col(ts), F.col(seq)]
    near = Window.partitionBy(*keys, "__period", SLOT).orderBy(*arrival)
    whole = Window.partitionBy(*keys, "__period").orderBy(*arrival)
    return (
        base.withColumn("__near", F.row_number().over(near))
        .where(F.col("__near") <= keep)
        .withColumn("__rank", F.row_number().over(whole))
        .where(F.col("__rank") <= keep)
        .withColumn("route", F.when(F.col("__rank") <= max_count, "main").otherwise("warning"))
        .drop(SLOT, "__period", "__near", "__rank")
    )


def blacklist_warnings(routed: DataFrame, keys: Sequence[str], max_count: int) -> DataFrame:
    return routed.where("route = 'warning'").select(
        *keys, F.lit(f"click over {max_count} times today").alias("msg")
    )


def fail_pair(
    df: DataFrame, key: str, ts: str, seq: str, is_fail: Column, gap: str = "2 seconds", slot: str = DEFAULT_SLOT
) -> DataFrame:
    """Two fails in a row less than ``gap`` apart; pairs overlap."""
    pairs = match_sequence(
        df, [key], ts, seq, [("first", is_fail), ("second", is_fail)], gap, "next", columns=[ts, seq], slot=slot
    )
    return pairs.where("route = 'match'").select(
        key,
        F.col(f"first.{ts}").alias("first_fail"),
        F.col(f"second.{ts}").alias("last_fail"),
        F.col(f"second.{seq}").alias(seq),
    )


def fail_burst(
    df: DataFrame,
    key: str,
    ts: str,
    seq: str,
    is_fail: Column,
    gap: str = "2 seconds",
    max_fails: int = 2,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Bursts of consecutive fails: the first unused fail and all fails of its run up to ``gap``
    after it (inclusive); the next burst begins after that. Bursts of ``max_fails`` or more are
    reported as (key, first_fail, last_fail, fails).

    A success ends a run, and so does a silence longer than ``gap``: the fail after it cannot be
    in a burst begun earlier. A key that only ever fails makes one endless run, so runs are cut
    into segments of the calendar and walked segment by segment:

    1. Which burst is open when a segment ends depends only on which of its first fails begins a
       burst, so ``_exits`` maps each possible first start (those within ``gap`` of the segment's
       beginning) to the last start.
    2. ``_entries`` follows these maps through a run, one small row set per segment, and tells each
       segment the burst it begins in.
    3. ``_cut`` walks every segment from there, and the parts of a burst add up.

    Only step 2 reads a run in one task, and it reads about ``gap / segment`` of its fails.
    """
    width = micros(gap)
    length = max(micros(slot), 16 * width)
    runs = islands(
        df,
        [key],
        ts,
        seq,
        F.struct(F.unix_micros(ts).alias("__at"), F.coalesce(is_fail, F.lit(False)).alias("__fail")),
        lambda p, c: ~p["__fail"] | ~c["__fail"] | (c["__at"] - p["__at"] > width),
        slot,
    )
    place = [key, "__run", "__segment"]
    pieces = (
        runs.where("__fail")
        .select(
            key,
            F.col("run_start.seq").alias("__run"),
            floor_micros(F.col("__at"), length).alias("__segment"),
            "__at",
            (floor_micros(F.unix_micros("run_start.ts"), length) == floor_micros(F.col("__at"), length)).alias("__opens"),
        )
        .repartition(*place)
    )
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}
    run, owner = (", ".join(f"`{c}` {kinds[c]}" for c in columns) for columns in (place[:2], place))
    entries = (
        pieces.sortWithinPartitions(*place, "__at")
        .mapInPandas(_exits(place, width, length), f"{owner}, first_us long, exit_us long, opens boolean")
        .repartition(key, "__run")
        .sortWithinPartitions(*place, "first_us")
        .mapInPandas(_entries(place, width), f"{owner}, __open long")
    )
    parts = (
        pieces.join(entries, place, "left")
        .sortWithinPartitions(*place, "__at")
        .mapInPandas(_cut(place, width), f"{run}, first_us long, last_us long, n long")
    )
    return (
        parts.groupBy(key, "__run", "first_us")
        .agg(F.max("last_us").alias("last_us"), F.sum("n").alias("fails"))
        .where(F.col("fails") >= max_fails)
        .select(
            key,
            F.timestamp_micros("first_us").alias("first_fail"),
            F.timestamp_micros("last_us").alias("last_fail"),
            "fails",
        )
    )


def _segments(batches: Iterator[pd.DataFrame], place: list[str], last_matters: int) -> Iterator[list[tuple]]:
    """Per sorted batch the (place, times, opens) of segments; one cut by a batch border is put together.

    A run goes on in the next segment only if its opening segment has a fail at ``last_matters`` or
    later; opening segments without one, nearly all, are left out.
    """
    rest = None
    for batch in chain(batches, [None]):
        rows = rest if batch is None else batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if rows is None or rows.empty:
            continue
        edges = np.array(_edges(rows, place))
        # the last segment may go on in the next batch
        closed = edges if batch is None else edges[:-1]
        begin, end = closed[:-1], closed[1:]
        at, opens = rows["__at"].to_numpy(), rows["__opens"].to_numpy()
        goes_on = ~opens[begin] | (at[end - 1] - rows["__segment"].to_numpy()[begin] >= last_matters)
        owner = [rows[c].to_numpy() for c in place]
        yield [
            (tuple(c[b] for c in owner), np.unique(at[b:e]), bool(opens[b]))
            for b, e in zip(begin[goes_on], end[goes_on])
        ]
        rest = rows.iloc[edges[-2] :]


def _edges(rows: pd.DataFrame, place: list[str]) -> list[int]:
    changed = np.zeros(len(rows) - 1, dtype=bool)
    for name in place:
        values = rows[name].to_numpy()
        changed |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(changed) + 1).tolist(), len(rows)]


def _exits(place: list[str], width: int, length: int):
    """Per segment: start of its last burst for each fail that may begin its first one."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for segments in _segments(batches, place, length - width):
            out = []
            for owner, at, opens in segments:
                reach = np.searchsorted(at, at + width, side="right")
                last = np.where(reach == len(at), np.arange(len(at)), np.minimum(reach, len(at) - 1))
                while not np.array_equal(last, last[last]):
                    last = last[last]
                # a burst open at the segment's beginning is over before beginning + width
                until = 1 if opens else 1 + int(np.searchsorted(at, owner[2] + width))
                out += [(*owner, first, leave, opens) for first, leave in zip(at[:until], at[last[:until]])]
            yield pd.DataFrame(out, columns=[*place, "first_us", "exit_us", "opens"])

    return scan


def _entries(place: list[str], width: int):
    """Per segment after a run's first: start of the burst that is open when it begins."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segment, start, after = None, None, None
        for batch in batches:
            out = []
            for key, run, begins, first, exits, opens in batch.itertuples(index=False, name=None):
                if opens:
                    segment, start, after = (key, run, begins), None, exits
                    continue
                if segment != (key, run, begins):
                    # the segment before has been read whole: its last start is now the open one
                    segment, start = (key, run, begins), after
                    out.append((key, run, begins, start))
                if after == start and first > start + width:
                    after = exits
            yield pd.DataFrame(out, columns=[*place, "__open"])

    return scan


def _cut(place: list[str], width: int):
    """Greedy bursts of each segment, the first continuing the burst that is open, if any."""
    columns = [*place[:2], "first_us", "last_us", "n"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, burst = None, None
        for batch in batches:
            if batch.empty:
                continue
            at, entry = batch["__at"].to_numpy(), batch["__open"].to_numpy()
            owners = list(zip(*[batch[c].to_numpy() for c in place]))
            done, edges = [], _edges(batch, place)
            for i, end in zip(edges[:-1], edges[1:]):
                if owners[i] != held:
                    if burst:
                        done.append(burst)
                    held, burst = owners[i], None
                    if not pd.isna(entry[i]):
                        burst = (*held[:2], int(entry[i]), None, 0)
                while i < end:
                    if burst:
                        j = bisect_right(at, burst[2] + width, i, end)
                        if j > i:
                            burst = (*burst[:3], int(at[j - 1]), burst[4] + j - i)
                            i = j
                            continue
                        done.append(burst)
                    burst = (*held[:2], int(at[i]), None, 0)
            yield _parts(done, columns)
        if burst:
            yield _parts([burst], columns)

    return scan


def _parts(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype({"last_us": "Int64"})
