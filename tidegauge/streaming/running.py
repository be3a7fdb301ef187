"""Running results on streams, one row out per row in, in event-time order.

Rows wait by (key, slot) in Spark's own aggregation. A key's closed slots come in order and one at a time; between
them its state keeps a few numbers, or a window's bitmap in pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.hashing import BITMAP_BITS, masked_hash
from tidegauge.functions.time import bucket_start, micros
from tidegauge.operators.timeline import DEFAULT_SLOT
from tidegauge.streaming.rules import AT, SLOT, InSlots, _kinds, _slotted

PIECE = 32_768  # bits


def _arrays(slots: DataFrame, keys: Sequence[str], *fields: str) -> DataFrame:
    return slots.select(*keys, SLOT, AT, *[F.col(f"rows.{f}").alias(f) for f in fields])


class _Sum(InSlots):
    fields = "us array<long>, seq array<long>, amount array<long>"

    def __init__(self, keys, width):
        super().__init__(keys, ["us", "seq", "total"], width)

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("sum", "total long")

    def take(self, slots, passed):
        before = total = self.state.get()[0] if self.state.exists() else None
        for _, times, seqs, amounts in slots:
            for us, seq, amount in zip(times, seqs, amounts):
                total = int(amount) + (total or 0)
                yield us, seq, total
        if total != before:
            self.state.update((total,))


def running_sum(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, col: Column, name: str = "running", scale: int = 0, slot: str = DEFAULT_SLOT
) -> DataFrame:
    """(keys, ts, seq, ``name``): the running sum of ``col``, exact to ``scale`` decimal places, per key in (ts, seq)
    order. Null adds nothing; rows without key or time take no part."""
    amount = F.coalesce((col.cast(f"decimal(38,{scale})") * 10**scale).cast("long"), F.lit(0))
    slots = _slotted(df, keys, ts, seq, slot, amount=amount)
    kinds = f"{_kinds(df, keys)}, us long, seq long, total long"
    sums = _arrays(slots, keys, "us", "seq", "amount").groupBy(*keys).transformWithStateInPandas(
        _Sum(keys, micros(slot)), kinds, "append", "EventTime"
    )
    total = F.col("total") if not scale else (F.col("total").cast("decimal(38,0)") / 10**scale).cast(f"decimal(38,{scale})")
    return sums.select(*keys, F.timestamp_micros("us").alias(ts), F.col("seq").alias(seq), total.alias(name))


class _Fold(InSlots):
    # readings as text, so that null stays null
    fields = "us array<long>, seq array<long>, reading array<string>"

    def __init__(self, key, tick, width):
        super().__init__([key], ["seq", "epoch", "first", "reading"], width)
        self.tick = tick

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("fold", "begin long, rows long")

    def take(self, slots, passed):
        begin, n = tuple(self.state.get()) if self.state.exists() else (None, 0)
        before = n
        for _, times, seqs, readings in slots:
            for us, seq, reading in zip(times, seqs, readings):
                begin = int(us) // 1_000_000 if begin is None else begin
                yield seq, begin + n * self.tick, n == 0, reading
                n += 1
        if n != before:
            self.state.update((begin, n))


def running_reduce(
    df: DataFrame, key: str, ts: str, value: str, seq: str, add: float = 10, tick: int = 1, slot: str = DEFAULT_SLOT
) -> DataFrame:
    """``operators.running.running_reduce`` on a stream: (key, seq, epoch, result)."""
    slots = _slotted(df, [key], ts, seq, slot, reading=F.col(value).cast("double").cast("string"))
    folded = _arrays(slots, [key], "us", "seq", "reading").groupBy(key).transformWithStateInPandas(
        _Fold(key, tick, micros(slot)), f"{_kinds(df, [key])}, seq long, epoch long, first boolean, reading string", "append", "EventTime"
    )
    reading = F.col("reading").cast("double")
    result = F.when(F.col("first"), reading).otherwise(reading + F.lit(add))
    return folded.select(key, F.col("seq").alias(seq), "epoch", result.alias("result"))


class _Bitmap(InSlots):
    """One window: its users' bits in pieces, of which the state reads and writes those that a trigger touches."""

    fields = "us array<long>, seq array<long>, user array<long>"

    def __init__(self, size, width):
        super().__init__(["start_us"], ["seq", "uv"], width)
        self.size = size

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("known", "uv long")
        self.pieces = handle.getMapState("pieces", "piece long", "bits binary")

    def take(self, slots, passed):
        known = self.state.exists()
        uv = self.state.get()[0] if known else 0
        before, touched, slot = uv, {}, None
        for slot, _, seqs, users in slots:
            for seq, user in zip(seqs, users):
                if user >= 0:
                    piece, bit = divmod(int(user), PIECE)
                    bits = touched.get(piece)
                    if bits is None:
                        stored = known and self.pieces.containsKey((piece,))
                        bits = touched[piece] = bytearray(self.pieces.getValue((piece,))[0] if stored else PIECE // 8)
                    mask = 1 << (bit & 7)
                    if not bits[bit >> 3] & mask:
                        bits[bit >> 3] |= mask
                        uv += 1
                yield seq, uv
        end = self.ends
        if end <= passed:
            if known:
                self.pieces.clear()
                self.state.clear()
        elif slot is not None:
            for piece, bits in touched.items():
                self.pieces.updateValue((piece,), (bytes(bits),))
            if not known or uv != before:
                self.state.update((uv,))
            self.wake(end - 1)

    def handleInputRows(self, key, rows, timerValues):
        self.ends = key[0] + self.size
        yield from super().handleInputRows(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.ends = key[0] + self.size
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


def running_unique(
    df: DataFrame, ts: str, size: str, user: str, seq: str, slot: str = "1 minute", bits: int = BITMAP_BITS
) -> DataFrame:
    """``operators.distinct.running_unique`` on a stream: for every event (seq, window_end, uv), the distinct
    hashed users of its window so far. A slot is no wider than the window, and divides it."""
    width, step = micros(size), micros(slot)
    if width % step:
        raise ValueError("size must be a multiple of slot")
    rows = df.withColumn("start_us", bucket_start(F.col(ts), width))
    slots = _slotted(rows, ["start_us"], ts, seq, slot, user=F.coalesce(masked_hash(F.col(user), bits=bits), F.lit(-1)))
    counted = _arrays(slots, ["start_us"], "us", "seq", "user").groupBy("start_us").transformWithStateInPandas(
        _Bitmap(width, step), "start_us long, seq long, uv long", "append", "EventTime"
    )
    return counted.select("seq", F.timestamp_micros(F.col("start_us") + width).alias("window_end"), "uv")
