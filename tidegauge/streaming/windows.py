"""Streaming forms of the distinct counts and joins.

Window aggregates, filters, parsing and routing need no form of their own: ``window_agg`` and the
functions of ``routing`` and ``parse`` take a stream as it is.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.functions.hashing import masked_hash
from tidegauge.functions.time import floor_micros, micros
from tidegauge.operators.timeline import DEFAULT_SLOT
from tidegauge.operators.windows import event_window
from tidegauge.streaming.rules import BUNDLE, EXACT, NAME, SLOT, _ms, bundled, by_slot, unbundled

BUCKET, CENTRE = "__bucket", "centre_us"


def unique_count(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """Exact distinct users per closed window (append mode): one state row per (window, user), then
    a count over them, so no state row holds a set."""
    known = df.where(F.col(user).isNotNull())
    pairs = known.groupBy(event_window(ts, size).alias("window"), user).agg(F.count(F.lit(1)).alias("__n"))
    return (
        pairs.groupBy("window").agg(F.count(F.lit(1)).alias("uv")).select(F.col("window.end").alias("window_end"), "uv")
    )


def bitmap_pieces(df: DataFrame, ts: str, size: str, user: str) -> DataFrame:
    """Running bitmap count per (window, piece of 32,768 bits) for update mode.

    Bits only ever get set, so a piece's newest count is its largest: keep it with
    ``to_upsert_table`` keyed by (window_end, piece) ordered by ``bits`` and add the pieces up.
    """
    hashed = df.select(F.col(ts), masked_hash(F.col(user)).alias("h"))
    return (
        hashed.groupBy(event_window(ts, size).alias("window"), F.bitmap_bucket_number("h").alias("piece"))
        .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("h"))).alias("bits"))
        .select(F.col("window.end").alias("window_end"), "piece", "bits")
    )


def approx_unique(df: DataFrame, ts: str, size: str, user: str, rsd: float = 0.01) -> DataFrame:
    """Running approximate distinct users per window, refined in update mode."""
    return (
        df.groupBy(event_window(ts, size).alias("window"))
        .agg(F.approx_count_distinct(user, rsd).alias("uv"))
        .select(F.col("window.end").alias("window_end"), "uv")
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lts: str,
    rts: str,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    how: str = "inner",
    slot: str = DEFAULT_SLOT,
    bundles: int = 128,
) -> DataFrame:
    """Stream-stream form of ``joins.interval_join``; both sides must carry a watermark, and the slower one decides.

    The inner join is Spark's own, on (keys, time bucket), with buckets as wide as the interval: a left row is in
    one, a right row in the one or two it can match in, so a hot key's rows are spread and only meet rows near
    them. The time bounds let Spark drop state neither side can match any more.

    ``full_outer`` also tells rows without partner, once all they could meet has passed. Copies in buckets would each
    count as unmatched there, so rows are grouped by (keys, ``slot``) and a slot lends its neighbours the rows they
    can reach; each row is told by its own slot. A slot's keys meet in ``bundles``. Rows without time take no part.
    """
    if how not in ("inner", "full_outer"):
        raise ValueError(f"unknown how {how!r}")
    low, high = micros(lower), micros(upper)
    if how == "full_outer":
        return _outer(left, right, keys, lts, rts, low, high, slot, bundles)
    width, at = max(high - low, 1), F.unix_micros(rts)
    ends = floor_micros(at - high, width), floor_micros(at - low, width)
    l = left.withColumn(BUCKET, floor_micros(F.unix_micros(lts), width)).alias("l")
    r = right.withColumn(BUCKET, F.explode(F.sequence(*ends, F.lit(width)))).alias("r")
    # literals, so that Spark can read the state bounds off the condition
    lt, rt = F.col(f"l.{lts}"), F.col(f"r.{rts}")
    same = (rt >= lt + F.lit(timedelta(microseconds=low))) & (rt <= lt + F.lit(timedelta(microseconds=high)))
    for k in (*keys, BUCKET):
        same = same & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    sides = [F.struct(*[F.col(f"{a}.{c}").alias(c) for c in df.columns]).alias(n)
             for a, n, df in (("l", "left", left), ("r", "right", right))]
    return l.join(r, same, "inner").select(*[F.col(f"l.{k}").alias(k) for k in keys], *sides)


PAIRS = 50_000  # in one frame


class _Meeting(StatefulProcessor):
    """Rows of one slot and a bundle of keys, and those lent to it by the slots beside it. Told when all slots that lend
    are in; until then, what a trigger brings is an entry of a list in state."""

    names = (NAME, "keyed", "home", "side", "us", "row")

    def __init__(self, low, high, width):
        self.low, self.high, self.width = low, high, width

    def init(self, handle):
        self.handle = handle
        self.parts = handle.getListState("parts", "columns string")

    def close(self) -> None:
        pass

    def told(self, frame: pd.DataFrame):
        key, us, row, home = pd.factorize(frame[NAME].to_numpy())[0], *[frame[n].to_numpy() for n in ("us", "row", "home")]
        # times by rank, so that (key, time) is one number
        times = np.unique(us)
        sides = [np.flatnonzero(frame["side"].to_numpy() == side) for side in (0, 1)]
        left, right = [at[np.lexsort((us[at], key[at]))] for at in sides]

        def met(own, others, low, high):
            """Of each row of ``own``, the first of ``others`` it meets, and how many."""
            place = key[others] * (len(times) + 1) + np.searchsorted(times, us[others])
            first, last = [
                np.searchsorted(place, key[own] * (len(times) + 1) + np.searchsorted(times, us[own] + by, at))
                for by, at in ((low, "left"), (high, "right"))
            ]
            # null keys equal nothing
            return first, np.where(frame["keyed"].to_numpy()[own], last - first, 0)

        own = left[home[left]]
        first, n = met(own, right, self.low, self.high)
        total, begin = np.cumsum(n), 0
        while begin < len(own):
            end = max(np.searchsorted(total, total[begin] - n[begin] + PAIRS, "right"), begin + 1)
            count = n[begin:end]
            l = np.repeat(own[begin:end], count)
            r = right[np.arange(len(l)) - np.repeat(np.cumsum(count) - count - first[begin:end], count)]
            yield self.out(frame, l, row[l], row[r])
            begin = end
        alone = own[n == 0]
        yield self.out(frame, alone, row[alone], None)
        own = right[home[right]]
        alone = own[met(own, left, -self.high, -self.low)[1] == 0]
        yield self.out(frame, alone, None, row[alone])

    @staticmethod
    def out(frame, at, left, right) -> pd.DataFrame:
        return pd.DataFrame({NAME: frame[NAME].to_numpy()[at], "left": left, "right": right}, dtype=object)

    def held(self) -> list[pd.DataFrame]:
        frames = [pd.DataFrame(json.loads(text)) for (text,) in self.parts.get()] if self.parts.exists() else []
        self.parts.clear()
        return frames

    def passed(self, timerValues) -> int:
        us = timerValues.getCurrentWatermarkInMs() * 1000
        return us - us % self.width

    def handleInputRows(self, key, rows, timerValues):
        due = key[1] + 2 * self.width
        if due <= self.passed(timerValues):
            yield from self.told(pd.concat([*self.held(), *[frame[list(self.names)] for frame in rows]], ignore_index=True))
        else:
            if not self.parts.exists():
                self.handle.registerTimer(_ms(due))
            for frame in rows:
                self.parts.appendValue((json.dumps({n: frame[n].tolist() for n in self.names}),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if frames := self.held():
            yield from self.told(pd.concat(frames, ignore_index=True))


def _outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], lts: str, rts: str, low: int, high: int, slot: str, bundles: int
) -> DataFrame:
    width, reach = micros(slot), max(abs(low), abs(high))
    if reach > width:
        raise ValueError("slot must be as wide as the interval reaches")

    def tagged(df: DataFrame, ts: str, side: int) -> DataFrame:
        row = F.struct(F.unix_micros(F.col(ts)).alias("us"), F.to_json(F.struct(*df.columns), EXACT).alias("row"))
        return df.select(*keys, F.col(ts).alias("time"), F.lit(side).alias("side"), row.alias("row"))

    both = tagged(left, lts, 0).unionByName(tagged(right, rts, 1))
    rows = F.collect_list(F.struct("side", F.col("row.us").alias("us"), F.col("row.row").alias("row")))
    slots = by_slot(both, keys, "time", slot, rows=rows)
    start = F.col(SLOT)

    def lent(to: int, near: str) -> Column:
        return F.struct((start + to).alias(CENTRE), F.lit(False).alias("home"), F.expr(f"filter(rows, x -> {near})").alias("rows"))

    own = F.struct(start.alias(CENTRE), F.lit(True).alias("home"), F.col("rows"))
    before = lent(-width, f"x.us < {SLOT} + {reach + 1}")
    after = lent(width, f"x.us >= {SLOT} + {width - reach}")
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    parts = slots.select(*bundled(keys, bundles), keyed.alias("keyed"), F.explode(F.array(own, before, after)).alias("p"))
    parts = parts.select(
        BUNDLE, F.col(f"p.{CENTRE}").alias(CENTRE), NAME, "keyed", F.col("p.home").alias("home"), F.explode("p.rows").alias("r")
    ).select(BUNDLE, CENTRE, NAME, "keyed", "home", "r.*")
    found = parts.groupBy(BUNDLE, CENTRE).transformWithStateInPandas(
        _Meeting(low, high, width), f"{NAME} string, left string, right string", "append", "EventTime"
    )
    found = unbundled(found, keys, left.schema)
    sides = [F.from_json(n, df.schema, EXACT).alias(n) for n, df in (("left", left), ("right", right))]
    return found.select(*keys, *sides)
