"""Sliding windows on streams, from panes.

A pane is one slide of a window. Spark's own streaming aggregation folds rows into panes by (key, pane); a
key's state holds the panes of one window, at most ``size / slide`` numbers, however many rows there are.
When panes close, what the windows ending there hold is swept as runs of equal values, and a run becomes
rows by ``sequence``. No row and no pane is copied to the windows that hold it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.time import micros
from tidegauge.streaming.rules import AT, _Keyed, _kinds, _ms


def _sums(panes: np.ndarray, values: np.ndarray, edges: np.ndarray, size: int, step: int) -> np.ndarray:
    """What windows ending at each edge sum up to: panes enter a slide after their start and leave a window later."""
    order = np.argsort(panes, kind="stable")
    total = np.concatenate(([0], np.cumsum(values[order])))
    starts = panes[order]
    return total[np.searchsorted(starts, edges - step, "right")] - total[np.searchsorted(starts, edges - size, "left")]


def _least(panes: np.ndarray, values: np.ndarray, edges: np.ndarray, size: int, step: int) -> np.ndarray:
    """The smallest value of the panes in the windows ending at each edge, NaN without any: a queue of panes
    that no later pane is below."""
    order = np.argsort(panes, kind="stable")
    rows = list(zip(panes[order].tolist(), values[order].tolist()))
    queue, at, out = deque(), 0, []
    for edge in edges.tolist():
        while at < len(rows) and rows[at][0] + step <= edge:
            while queue and queue[-1][1] >= rows[at][1]:
                queue.pop()
            queue.append(rows[at])
            at += 1
        while queue and queue[0][0] + size < edge:
            queue.popleft()
        out.append(queue[0][1] if queue else np.nan)
    return np.array(out)


class _Panes(_Keyed):
    """Panes in, runs of window ends with equal values out."""

    def __init__(self, keys, size, step, base, least):
        super().__init__(keys, ["first_end", "last_end", "result"])
        self.size, self.step, self.base, self.least = size, step, base, least

    def init(self, handle):
        self.handle = handle
        kind = "double" if self.least else "long"
        self.state = handle.getValueState("panes", f"panes array<long>, amounts array<{kind}>, told long")

    def sweep(self, key, panes: list[np.ndarray], values: list[np.ndarray], timerValues):
        # all panes that end by now are in
        now = timerValues.getCurrentWatermarkInMs() * 1000
        now -= (now - self.base) % self.step
        told = None
        if self.state.exists():
            held = self.state.get()
            told = held[2]
            panes, values = [np.array(held[0], np.int64), *panes], [np.array(held[1]), *values]
        panes, values = np.concatenate(panes), np.concatenate(values)
        begin = panes.min() + self.step if told is None else told + self.step
        if begin <= now:
            edges = np.concatenate((panes + self.step, panes + self.size + self.step, [begin]))
            edges = np.unique(edges[(edges >= begin) & (edges <= now)])
            found = (_least if self.least else _sums)(panes, values, edges, self.size, self.step)
            until = np.append(edges[1:], now + self.step) - self.step
            some = ~np.isnan(found) if self.least else found > 0
            if some.any():
                out = pd.DataFrame({"first_end": edges[some], "last_end": until[some], "result": found[some]})
                for i, k in enumerate(self.keys):
                    out.insert(i, k, key[i])
                yield out
            told = now
        open_ = panes + self.size > now
        if open_.any():
            told = int(begin - self.step if told is None else told)
            self.state.update((panes[open_].tolist(), values[open_].tolist(), told))
            self.handle.registerTimer(_ms(now + self.step))
        elif self.state.exists():
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)  # two numbers a pane
        panes = [f["pane_us"].to_numpy(np.int64) for f in frames]
        values = [f["amount"].to_numpy() for f in frames]
        yield from self.sweep(key, panes, values, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            yield from self.sweep(key, [], [], timerValues)


def _swept(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], offset: str | None, amount: Column, least: bool):
    width, step = micros(size), micros(slide)
    if width % step:
        raise ValueError("size must be a multiple of slide")
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    base = micros(offset) % step if offset else 0
    pane = F.window(ts, slide, slide, f"{base} microseconds") if base else F.window(ts, slide)
    panes = df.groupBy(*keys, pane.alias("__pane")).agg(amount.alias("amount")).where("amount is not null")
    panes = panes.select(*keys, F.unix_micros("__pane.start").alias("pane_us"), F.window_time("__pane").alias(AT), "amount")
    kind = "double" if least else "long"
    runs = panes.groupBy(*keys).transformWithStateInPandas(
        _Panes(keys, width, step, base, least),
        f"{_kinds(df, keys)}, first_end long, last_end long, result {kind}",
        "append",
        "EventTime",
    )
    ends = runs.select(*keys, F.explode(F.sequence("first_end", "last_end", F.lit(step))).alias("end"), "result")
    return ends.select(
        *keys, F.timestamp_micros(F.col("end") - width).alias("window_start"), F.timestamp_micros("end").alias("window_end"), "result"
    )


def sliding_count(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], offset: str | None = None
) -> DataFrame:
    """``operators.windows.sliding_count`` on a stream with a watermark: keys, window_start, window_end, count of
    each window that has rows, once, when the watermark passes its end. Rows with a null key take no part."""
    found = _swept(df, ts, size, slide, keys, offset, F.count(F.lit(1)), False)
    return found.withColumnRenamed("result", "count")


def sliding_min(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], value: str, name: str, offset: str | None = None
) -> DataFrame:
    """The smallest double ``value`` of each window as ``name``, told like ``sliding_count``. Null values take no
    part; windows without any other are left out."""
    found = _swept(df, ts, size, slide, keys, offset, F.min(F.col(value).cast("double")), True)
    return found.withColumnRenamed("result", name)
