"""Keyed rules on streams, cut into time slots.

A key may own a third of the rows, so its rows are grouped by (key, slot) first, by Spark's own streaming
aggregation: many tasks hold a hot key's waiting rows, and a slot leaves, in (time, seq) order, when the
watermark has passed it. What a slot can tell alone is worked out there by column expressions. Only
what it takes from the slots before, a value or a few, goes on to the state of the key, which gets
slots in order. So answers do not depend on the order of arrival within the watermark's delay, and come
when the slot has ended; a shorter ``slot`` tells earlier. ``slot`` divides a day.

Where keys are many and each has few slots, a call of Python per key costs more than the rule. ``InBundles`` takes
keys in bundles by their hash, and keeps what it knows of a bundle's keys together.

Rows without key or time take no part. Times travel as microseconds (``us``); timers are in milliseconds,
rounded up so that they fire no earlier than due.

``rising_alert`` measures processing time and looks at rows as they arrive.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidegauge.functions.time import micros
from tidegauge.operators import orders
from tidegauge.operators.rules import RISING_TEXT
from tidegauge.operators.timeline import DEFAULT_SLOT, on_timeline

_DAY = 86_400_000_000
# names with a leading underscore do not reach a stateful processor
SLOT, AT, DAY = "slot_us", "slot_at", "click_day"
BUNDLE, NAME = "bundle", "key_text"
# times in JSON keep their microseconds
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
NEVER = (1 << 63) - 1  # stands for a time that is not known
SILENT = ""  # an outcome that is not reported


def _ordered(rows: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
    """Columns of one key's rows in (time, seq) order. Keys are many and their rows few, so this
    stays with plain arrays, whose fixed costs are small."""
    frames = list(rows)
    frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    columns = {c: frame[c].to_numpy() for c in frame.columns}
    order = np.lexsort((columns["seq"], columns["us"]))
    return {c: values[order] for c, values in columns.items()}


def _ms(us: int) -> int:
    return -(-us // 1000)


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"`{k}` {types[k]}" for k in keys)


def _prepare(df: DataFrame, keys: Sequence[str], ts: str, seq: str, **extra: Column) -> DataFrame:
    return on_timeline(df, keys, ts).select(
        *keys,
        F.col(ts),
        F.unix_micros(F.col(ts)).alias("us"),
        F.col(seq).cast("long").alias("seq"),
        *[c.alias(n) for n, c in extra.items()],
    )


def _flag(holds: Column) -> Column:
    return F.coalesce(holds, F.lit(False))


def by_slot(df: DataFrame, keys: Sequence[str], ts: str, slot: str, **aggregates: Column) -> DataFrame:
    """(keys, slot as microseconds, its event time, aggregates) of each slot that the watermark has passed."""
    slots = df.groupBy(*keys, F.window(ts, slot).alias("__window")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return slots.select(
        *keys, F.unix_micros("__window.start").alias(SLOT), F.window_time("__window").alias(AT), *aggregates
    )


def _slotted(df: DataFrame, keys: Sequence[str], ts: str, seq: str, slot: str, **fields: Column) -> DataFrame:
    """Slots with ``rows``: their (us, seq, fields) in order."""
    rows = _prepare(df, keys, ts, seq, **fields)
    row = F.struct("us", "seq", *fields)
    return by_slot(rows, keys, ts, slot, rows=F.array_sort(F.collect_list(row)))


class _Keyed(StatefulProcessor):
    """Base: names of the key columns and how to build output rows."""

    def __init__(self, keys: Sequence[str], columns: Sequence[str]):
        self.keys, self.columns = list(keys), [*keys, *columns]

    def out(self, key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame([(*key, *row) for row in rows], columns=self.columns)

    def close(self) -> None:
        pass


class InSlots(_Keyed):
    """Base of the rules that take a key's closed slots in order: ``take`` gets (slot, *fields) of each new
    one, in turn, and the time before which all slots have been handed over. A key's slots of one trigger
    come in pieces if they are many; these are put into state by slot, and taken from there one by one."""

    fields = ""  # of a slot, with their types

    def __init__(self, keys: Sequence[str], columns: Sequence[str], width: int):
        super().__init__(keys, columns)
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.many = handle.getMapState("many", f"{SLOT} long", self.fields)

    def take(self, slots: Iterator[tuple], passed: int) -> Iterator[tuple]:
        raise NotImplementedError

    def wake(self, us: int) -> None:
        """Have ``take`` called once all slots up to the one of ``us`` have been handed over."""
        self.handle.registerTimer(_ms(us - us % self.width + self.width))

    def in_order(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        names = [SLOT, *[f.split()[0] for f in self.fields.split(", ")]]
        one, more = next(rows, None), next(rows, None)
        if one is None:
            return
        if more is None:
            yield from sorted(zip(*(one[n].tolist() for n in names)), key=lambda s: s[0])
            return
        slots: list[int] = []
        for frame in (one, more, *rows):
            for slot, *rest in zip(*(frame[n].tolist() for n in names)):
                self.many.updateValue((slot,), tuple(x.tolist() if isinstance(x, np.ndarray) else x for x in rest))
                slots.append(slot)
        for slot in sorted(slots):
            yield slot, *self.many.getValue((slot,))
            self.many.removeKey((slot,))

    def passed(self, timerValues) -> int:
        us = timerValues.getCurrentWatermarkInMs() * 1000
        return us - us % self.width

    def batches(self, key: tuple, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        held = []
        for row in rows:
            held.append(row)
            if len(held) == 10_000:
                yield from self.out(key, held)
                held = []
        yield from self.out(key, held)

    def handleInputRows(self, key, rows, timerValues):
        yield from self.batches(key, self.take(self.in_order(iter(rows)), self.passed(timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.batches(key, self.take(iter(()), self.passed(timerValues)))


def bundled(keys: Sequence[str], bundles: int) -> list[Column]:
    """The bundle of a row's keys, and the keys as text."""
    return [F.pmod(F.xxhash64(*keys), F.lit(bundles)).cast("int").alias(BUNDLE), F.to_json(F.struct(*keys), EXACT).alias(NAME)]


def unbundled(df: DataFrame, keys: Sequence[str], kinds: StructType) -> DataFrame:
    """``df`` with the keys, of the types they have in ``kinds``, in place of their text."""
    keys_of = F.from_json(NAME, StructType([kinds[k] for k in keys]), EXACT).alias("key")
    rest = [c for c in df.columns if c != NAME]
    return df.select(keys_of, *rest).select("key.*", *rest)


class InBundles(StatefulProcessor):
    """Base of the rules that take the closed slots of many keys, a bundle, at a time. What is known of the keys, by
    their texts, is a log of JSON objects in state, of which the newest entry of a key counts (null: forgotten). So a
    trigger writes what it changed, and reads a bundle at once; a log that is mostly out of date is written anew."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.log = handle.getListState("log", "entries string")

    def read(self) -> dict:
        known, self.logged = {}, 0
        if self.log.exists():
            for (text,) in self.log.get():
                entries = json.loads(text)
                known.update(entries)
                self.logged += len(entries)
        return {name: held for name, held in known.items() if held is not None}

    def write(self, known: dict, changed: Iterable[str]) -> None:
        entries = {name: known.get(name) for name in changed}
        if not known:
            if self.logged:
                self.log.clear()
        elif entries and self.logged + len(entries) > 2 * len(known):
            self.log.put([(json.dumps(known),)])
        elif entries:
            self.log.appendValue((json.dumps(entries),))

    def wake(self, us: int) -> None:
        """Set a timer for when all slots up to the one of ``us`` have been handed over."""
        self.handle.registerTimer(_ms(us - us % self.width + self.width))

    def passed(self, timerValues) -> int:
        us = timerValues.getCurrentWatermarkInMs() * 1000
        return us - us % self.width

    def close(self) -> None:
        pass


class _Carry(InSlots):
    """Hands each slot what the key's slot before it held, along with its own payload, which is not looked at."""

    fields = "held string, own string"

    def __init__(self, keys, width, keep):
        super().__init__(keys, [SLOT, "before", "own"], width)
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("carried", "held string, until long")

    def take(self, slots, passed):
        before, until = tuple(self.state.get()) if self.state.exists() else (None, None)
        slot = None
        for slot, held, own in slots:
            yield slot, before, own
            before = held
        if slot is not None:
            until = slot + self.width + self.keep if self.keep is not None else NEVER
            self.state.update((before, until))
            if self.keep is not None:
                self.wake(until)
        elif until is not None and until <= passed:
            self.state.clear()


def _carried(slots: DataFrame, keys: Sequence[str], width: str, held: Column, own: Column, keep: str | None = None) -> DataFrame:
    """(keys, slot, before, own): ``held`` of the slot before, a struct as JSON, and the JSON ``own``. What a key
    holds is forgotten ``keep`` after its last slot."""
    rows = slots.select(*keys, SLOT, AT, F.to_json(held).alias("held"), own.alias("own"))
    carry = _Carry(keys, micros(width), micros(keep) if keep else None)
    kinds = f"{_kinds(slots, keys)}, {SLOT} long, before string, own string"
    return rows.groupBy(*keys).transformWithStateInPandas(carry, kinds, "append", "EventTime")


def _told(found: Column) -> Column:
    """A slot's own rows as JSON, or null without any."""
    return F.when(F.size(found) > 0, F.to_json(found))


_PAIRS = "filter(zip_with(slice(rows, 1, size(rows) - 1), slice(rows, 2, size(rows) - 1), (x, y) -> {row}), p -> {hit})"


def jump_alert(
    df: DataFrame, key: str, ts: str, value: str, seq: str, threshold: float = 10.0, first_as_zero: bool = False,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    slots = _slotted(df, [key], ts, seq, slot, value=F.col(value).cast("double"))
    kind = "struct<seq: bigint, last_value: double, value: double>"
    row = "named_struct('seq', y.seq, 'last_value', x.value, 'value', y.value)"
    inside = F.expr(_PAIRS.format(row=row, hit=f"abs(p.value - p.last_value) > {threshold!r}D"))
    head, tail = F.col("rows")[0], F.element_at("rows", -1)
    own = F.to_json(F.struct(head["seq"].alias("seq"), head["value"].alias("value"), inside.alias("inside")))
    found = _carried(slots, [key], slot, F.struct(tail["value"].alias("value")), own)
    own = F.from_json("own", f"seq bigint, value double, inside array<{kind}>")
    first = F.lit(0.0) if first_as_zero else F.lit(None).cast("double")
    last = F.when(F.col("before").isNull(), first).otherwise(F.from_json("before", "value double")["value"])
    met = found.select(key, own.alias("own"), last.alias("last"))
    edge = F.struct(F.col("own.seq").alias("seq"), F.col("last").alias("last_value"), F.col("own.value").alias("value"))
    edge = F.when(F.abs(F.col("own.value") - F.col("last")) > threshold, F.array(edge)).otherwise(F.array().cast(f"array<{kind}>"))
    return met.select(key, F.explode(F.concat(edge, "own.inside")).alias("hit")).select(key, "hit.*")


class _Rising(_Keyed):
    def __init__(self, key, hold_ms):
        super().__init__([key], ["msg"])
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long, value double")
        self.timer = handle.getValueState("timer", "due long")

    def handleInputRows(self, key, rows, timerValues):
        batch = _ordered(rows)
        last = self.last.get() if self.last.exists() else None
        due = self.timer.get()[0] if self.timer.exists() else None
        armed = due
        for us, value in zip(batch["us"], batch["value"]):
            if last is not None and us >= last[0]:
                if value <= last[1]:
                    armed = None
                elif us > last[0] and armed is None:
                    armed = timerValues.getCurrentProcessingTimeInMs() + self.hold_ms
            last = (int(us), float(value))
        self.last.update(last)
        if armed != due:
            if due is not None:
                self.handle.deleteTimer(due)
                self.timer.clear()
            if armed is not None:
                self.handle.registerTimer(armed)
                self.timer.update((armed,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        yield from self.out(key, [(f"{key[0]}{RISING_TEXT}",)])


def rising_alert(df: DataFrame, key: str, ts: str, value: str, seq: str, hold: str = "10 seconds") -> DataFrame:
    """Alert when readings have kept rising for ``hold`` of processing time; while they go on
    rising, a new period begins with the next reading."""
    rows = _prepare(df, [key], ts, seq, value=F.col(value))
    return rows.groupBy(key).transformWithStateInPandas(
        _Rising(key, _ms(micros(hold))), f"{_kinds(df, [key])}, msg string", "append", "ProcessingTime"
    )


class _Counts(InBundles):
    """A day's counts of a bundle of keys. Hands each slot the sum of ``held`` over the key's slots before it in the
    day, if that is at most ``most``. When the day has passed, nothing is kept of it."""

    def __init__(self, most, width):
        super().__init__(width)
        self.most = most

    def handleInputRows(self, key, rows, timerValues):
        frames = list(rows)  # a day's slots of one bundle at most
        frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        known, end = self.read(), (key[1] + 1) * _DAY
        codes, names = pd.factorize(frame[NAME].to_numpy())
        order = np.lexsort((frame[SLOT].to_numpy(), codes))
        codes, held = codes[order], frame["held"].to_numpy()[order]
        total = np.cumsum(held)
        first = np.searchsorted(codes, np.arange(len(names)))
        last = np.append(first[1:], len(codes)) - 1
        counted = np.array([known.get(name, 0) for name in names], np.int64)
        base = counted - total[first] + held[first]
        before = total - held + base[codes]
        low = before <= self.most
        yield pd.DataFrame({NAME: names[codes[low]], "before": before[low], "own": frame["own"].to_numpy()[order][low]})
        if end <= self.passed(timerValues):
            self.log.clear()
        else:
            known.update(zip(names.tolist(), (total[last] + base).tolist()))
            self.write(known, names.tolist())
            self.wake(end - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.log.clear()
        yield from ()


def click_blacklist(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, max_count: int = 100, slot: str = DEFAULT_SLOT, bundles: int = 128
) -> DataFrame:
    """(keys, ts, seq, route) of clicks let through and of the one that set off the warning. A slot sends at most
    ``max_count`` + 1 clicks on. Counts are kept in ``bundles`` a day, until the day has passed."""
    slots = _slotted(df, keys, ts, seq, slot)
    own = F.to_json(F.slice("rows", 1, max_count + 1))
    day = F.floor(F.col(SLOT) / _DAY).cast("long").alias(DAY)
    rows = slots.select(*bundled(keys, bundles), day, SLOT, F.size("rows").cast("long").alias("held"), own.alias("own"))
    found = rows.groupBy(BUNDLE, DAY).transformWithStateInPandas(
        _Counts(max_count, micros(slot)), f"{NAME} string, before long, own string", "append", "EventTime"
    )
    clicks = found.select(
        NAME, "before", F.posexplode(F.from_json("own", "array<struct<us: bigint, seq: bigint>>")).alias("at", "click")
    )
    n = F.col("before") + F.col("at") + 1
    clicks = clicks.where(n <= max_count + 1).select(
        NAME,
        F.timestamp_micros("click.us").alias(ts),
        F.col("click.seq").alias(seq),
        F.when(n <= max_count, "main").otherwise("warning").alias("route"),
    )
    return unbundled(clicks, keys, df.schema)


class _Burst(InSlots):
    """Slots as (failures before the first other row, whether there is such a row, bursts after it, the
    burst still open at the end): only the first part depends on the slots before."""

    fields = "fails array<long>, broken boolean, done string, open array<long>"

    def __init__(self, key, gap, max_fails, width):
        super().__init__([key], ["first_us", "last_us", "fails", "done"], width)
        self.gap, self.max_fails = gap, max_fails

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("open", "first_us long, last_us long, fails long")

    def take(self, slots, passed):
        held = tuple(self.state.get()) if self.state.exists() else None
        burst = held
        for _, fails, broken, done, open_ in slots:
            for us in fails:
                if burst and us > burst[0] + self.gap:
                    if burst[2] >= self.max_fails:
                        yield *burst, None
                    burst = None
                burst = (burst[0], us, burst[2] + 1) if burst else (us, us, 1)
            if broken:
                if burst and burst[2] >= self.max_fails:
                    yield *burst, None
                if done is not None:
                    yield 0, 0, 0, done
                burst = tuple(open_) if len(open_) else None
        if burst and burst[0] + self.gap < passed:
            if burst[2] >= self.max_fails:
                yield *burst, None
            burst = None
        if burst and burst != held:
            self.state.update(tuple(int(x) for x in burst))
            self.wake(int(burst[0]) + self.gap)
        elif held and not burst:
            self.state.clear()


def fail_burst(
    df: DataFrame, key: str, ts: str, seq: str, is_fail: Column, gap: str = "2 seconds", max_fails: int = 2,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Bursts as in ``operators.rules.fail_burst``. A slot's rows after its first row that is no failure are
    folded where they are; the failures before that follow the open burst of the slots before."""
    slots = _slotted(df, [key], ts, seq, slot, fail=_flag(is_fail))
    keep = f"acc.f is not null and r.fail and r.us <= acc.f + {micros(gap)}"
    bursts = "array<struct<f: bigint, l: bigint, n: bigint>>"
    ended = f"acc.f is not null and not ({keep}) and acc.n >= {max_fails}"
    fold = f"""aggregate(slice(rows, size(fails) + 1, size(rows)),
        named_struct('done', cast(array() as {bursts}), 'f', cast(null as bigint), 'l', cast(null as bigint), 'n', 0L),
        (acc, r) -> named_struct(
            'done', if({ended}, array_append(acc.done, named_struct('f', acc.f, 'l', acc.l, 'n', acc.n)), acc.done),
            'f', if({keep}, acc.f, if(r.fail, r.us, null)), 'l', if(r.fail, r.us, null),
            'n', if({keep}, acc.n + 1, if(r.fail, 1L, 0L))))"""
    # the failures before the first other row
    first = "aggregate(rows, 0, (n, r) -> if(n >= 0 and r.fail, n + 1, if(n >= 0, -n - 1, n)))"
    lead = F.expr(first)
    slots = slots.withColumn("lead", F.when(lead < 0, -lead - 1).otherwise(lead))
    slots = slots.withColumn("fails", F.expr("transform(slice(rows, 1, lead), r -> r.us)")).withColumn("after", F.expr(fold))
    open_ = F.when(F.col("after.f").isNotNull(), F.array("after.f", "after.l", "after.n")).otherwise(F.array().cast("array<long>"))
    rows = slots.select(
        key, SLOT, AT, "fails", (F.size("fails") < F.size("rows")).alias("broken"), _told(F.col("after.done")).alias("done"),
        open_.alias("open"),
    )
    found = rows.groupBy(key).transformWithStateInPandas(
        _Burst(key, micros(gap), max_fails, micros(slot)),
        f"{_kinds(df, [key])}, first_us long, last_us long, fails long, done string",
        "append",
        "EventTime",
    )
    one = F.array(F.struct(F.col("first_us").alias("f"), F.col("last_us").alias("l"), F.col("fails").alias("n")))
    each = F.when(F.col("done").isNull(), one).otherwise(F.from_json("done", bursts))
    return found.select(key, F.explode(each).alias("b")).select(
        key, F.timestamp_micros("b.f").alias("first_fail"), F.timestamp_micros("b.l").alias("last_fail"), F.col("b.n").alias("fails")
    )


def fail_pair(
    df: DataFrame, key: str, ts: str, seq: str, is_fail: Column, gap: str = "2 seconds", slot: str = DEFAULT_SLOT
) -> DataFrame:
    slots = _slotted(df, [key], ts, seq, slot, fail=_flag(is_fail))
    kind = "struct<first_us: bigint, last_us: bigint, seq: bigint>"
    near = f"x.fail and y.fail and y.us - x.us < {micros(gap)}"
    row = f"if({near}, named_struct('first_us', x.us, 'last_us', y.us, 'seq', y.seq), null)"
    inside = F.expr(_PAIRS.format(row=row, hit="p is not null"))
    head, tail = F.col("rows")[0], F.element_at("rows", -1)
    own = F.to_json(F.struct(head.alias("head"), inside.alias("inside")))
    found = _carried(slots, [key], slot, F.struct(tail["us"].alias("us"), tail["fail"].alias("fail")), own, keep=gap)
    own = F.from_json("own", f"head struct<us: bigint, seq: bigint, fail: boolean>, inside array<{kind}>")
    met = found.select(key, own.alias("own"), F.from_json("before", "us bigint, fail boolean").alias("x"))
    head = F.col("own.head")
    hit = F.col("x.fail") & head["fail"] & (head["us"] - F.col("x.us") < micros(gap))
    edge = F.struct(F.col("x.us").alias("first_us"), head["us"].alias("last_us"), head["seq"].alias("seq"))
    edge = F.when(hit, F.array(edge)).otherwise(F.array().cast(f"array<{kind}>"))
    pairs = met.select(key, F.explode(F.concat(edge, "own.inside")).alias("p"))
    return pairs.select(
        key,
        F.timestamp_micros("p.first_us").alias("first_fail"),
        F.timestamp_micros("p.last_us").alias("last_fail"),
        F.col("p.seq").alias(seq),
    )


class _Orders(InBundles):
    """Orders, each as (first create, first pay, what was said of it last)."""

    def __init__(self, threshold, disorder, remember, width):
        super().__init__(width)
        self.threshold, self.disorder, self.remember = threshold, disorder, remember

    def told(self, create, pay, msg, due, passed):
        if create != NEVER and pay != NEVER and msg in (None, orders.UNPAID):
            if create - pay > self.disorder:
                said = orders.NO_CREATE
            else:
                said = orders.PAID if pay < create + self.threshold else orders.PAID_LATE
            # a payment after the alarm is reported late once more, never as paid in time
            return said if msg is None or said == orders.PAID_LATE else None
        if msg is None and due < passed:
            return orders.NO_CREATE if create == NEVER else orders.UNPAID
        return None

    def due(self, create, pay):
        return create + self.threshold if create != NEVER else pay + self.disorder

    def take(self, rows, passed):
        known, changed, told, soonest = self.read(), set(), [], NEVER
        for frame in rows:
            for name, create, pay in zip(*(frame[n].tolist() for n in (NAME, "create_us", "pay_us"))):
                held = known.get(name, (NEVER, NEVER, None))
                if create < held[0] or pay < held[1]:
                    known[name] = min(create, held[0]), min(pay, held[1]), held[2]
                    changed.add(name)
        for name, (create, pay, msg) in list(known.items()):
            due = self.due(create, pay)
            said = self.told(create, pay, msg, due, passed)
            if said == SILENT:
                continue  # waits for nothing
            if said:
                told.append((name, said))
                msg = said
                known[name] = create, pay, msg
                changed.add(name)
            until = due if msg is None else due + self.remember
            if msg is not None and until < passed:
                del known[name]
                changed.add(name)
            else:
                soonest = min(soonest, until)
        self.write(known, changed)
        if soonest != NEVER:
            self.wake(soonest)
        if told:
            yield pd.DataFrame(told, columns=[NAME, "msg"])

    def handleInputRows(self, key, rows, timerValues):
        yield from self.take(rows, self.passed(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.take((), self.passed(timerValues))


def _orders(
    df: DataFrame, keys: Sequence[str], ts: str, slot: str, is_create: Column, is_pay: Column, rule: _Orders, bundles: int
) -> DataFrame:
    """(keys, msg): what ``rule`` tells of orders."""
    rows = on_timeline(df.where(is_create | is_pay), keys, ts)
    first = {n: F.coalesce(F.min(F.when(c, F.unix_micros(F.col(ts)))), F.lit(NEVER))
             for n, c in (("create_us", is_create), ("pay_us", is_pay))}
    slots = by_slot(rows, keys, ts, slot, **first).select(*bundled(keys, bundles), *first)
    told = slots.groupBy(BUNDLE).transformWithStateInPandas(rule, f"{NAME} string, msg string", "append", "EventTime")
    return unbundled(told, keys, df.schema)


def order_match(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    is_create: Column,
    is_pay: Column,
    threshold: str = "120 seconds",
    disorder: str = "0 seconds",
    remember: str = "30 days",
    slot: str = DEFAULT_SLOT,
    bundles: int = 1024,
) -> DataFrame:
    """Outcome per order as in ``operators.orders.order_match``, told once the watermark has passed the slot of
    what decides it. A slot sends its first create and first pay.

    When the watermark passes the deadline of an unpaid order it is reported as timed out; should a
    payment come later still, ``paid but timeout`` follows as a second row. An order is forgotten when
    its outcome is told and the watermark is ``remember`` past its deadline; rows that come after that
    begin a new one.
    """
    rule = _Orders(micros(threshold), micros(disorder), micros(remember), micros(slot))
    told = _orders(df, keys, ts, slot, is_create, is_pay, rule, bundles)
    return told.withColumn("route", F.when(F.col("msg") == orders.PAID, "main").otherwise("side"))


class _Warnings(_Orders):
    def told(self, create, pay, msg, due, passed):
        if msg is not None or due >= passed:
            return None
        if create == NEVER or pay < create:
            return SILENT
        return orders.WARN_PAID if pay <= due else orders.WARN_UNPAID

    def due(self, create, pay):
        return (create if create != NEVER else pay) + self.threshold


def order_warning(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    is_create: Column,
    is_pay: Column,
    threshold: str = "120 seconds",
    remember: str = "30 days",
    slot: str = DEFAULT_SLOT,
    bundles: int = 1024,
) -> DataFrame:
    """Warning per created order as in ``operators.orders.order_warning``, told when the watermark passes
    the slot of the deadline. An order is forgotten ``remember`` later."""
    rule = _Warnings(micros(threshold), 0, micros(remember), micros(slot))
    return _orders(df, keys, ts, slot, is_create, is_pay, rule, bundles)
