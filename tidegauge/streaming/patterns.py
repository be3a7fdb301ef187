"""Sequences of any number of steps on streams.

An automaton per key: a partial match waits for its next step, by ``next`` or ``followed_by``. All that wait
for the same step move on together, so they are one buffer, kept in state in pieces by the step waited
for and the slot of the start. A piece is read only when a row fits its step, or when its time is up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from tidegauge.functions.time import micros
from tidegauge.operators.patterns import FOLLOWED_BY, NEXT
from tidegauge.operators.timeline import DEFAULT_SLOT
from tidegauge.streaming.rules import AT, SLOT, InSlots, _flag, _kinds, _slotted


class _Matcher(InSlots):
    """A slot's rows come as three arrays: time, seq and, by bits, the steps a row fits. A partial match is the
    list of (us, seq) it has reached, flat."""

    fields = "us array<long>, seq array<long>, fits array<long>"

    def __init__(self, keys, names, links, within, width):
        steps = [f"{n}_{c}" for n in names for c in ("us", "seq")]
        super().__init__(keys, [*steps, "route"], width)
        self.links, self.within, self.final = links, within, len(names) - 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        # number tells the pieces of a (step, slot) apart
        self.parts = handle.getMapState("parts", "step long, slot long, number long", "reached array<array<long>>")
        self.numbers = handle.getValueState("numbers", "next long")

    def done(self, reached: list[int], route: str) -> tuple:
        return (*reached, *[None] * (2 * self.final + 2 - len(reached)), route)

    def take(self, slots: Iterator[tuple], passed: int) -> Iterator[tuple]:
        number = self.numbers.get()[0] if self.numbers.exists() else 0
        stored: dict[int, list[tuple]] = {}  # by step waited for: keys of pieces in state
        if number:
            for step, slot, n in self.parts.keys():
                stored.setdefault(step, []).append((step, slot, n))
        new: dict[int, list[list[int]]] = {}  # by step: what began to wait for it since

        def waiting(step: int) -> list[list[int]]:
            held = []
            for piece in sorted(stored.pop(step, [])):
                held += [list(r) for r in self.parts.getValue(piece)[0]]
                self.parts.removeKey(piece)
            return held + new.pop(step, [])

        for _, times, seqs, fits in slots:
            for us, seq, fit in zip(times, seqs, fits):
                us, seq, fit = int(us), int(seq), int(fit)
                for step in range(self.final, 0, -1):
                    strict = self.links[step - 1] == NEXT
                    if not (strict or fit >> step & 1) or not (step in new or step in stored):
                        continue
                    for reached in waiting(step):
                        if us - reached[0] >= self.within:
                            yield self.done(reached, "timeout")
                        elif fit >> step & 1:
                            reached = [*reached, us, seq]
                            if step == self.final:
                                yield self.done(reached, "match")
                            else:
                                new.setdefault(step + 1, []).append(reached)
                if fit & 1:
                    if self.final:
                        new.setdefault(1, []).append([us, seq])
                    else:
                        yield self.done([us, seq], "match")

        # pieces by the slot of their starts; a slot's time is up when that of its last start is
        oldest = None
        for step, held in new.items():
            pieces: dict[int, list[list[int]]] = {}
            for reached in held:
                pieces.setdefault(reached[0] - reached[0] % self.width, []).append(reached)
            for slot, part in pieces.items():
                if slot + self.width + self.within <= passed:
                    for reached in part:
                        yield self.done(reached, "timeout")
                    continue
                self.parts.updateValue((step, slot, number), (part,))
                number += 1
                oldest = slot if oldest is None else min(oldest, slot)
        for pieces in stored.values():
            for piece in pieces:
                if piece[1] + self.width + self.within <= passed:
                    for reached in self.parts.getValue(piece)[0]:
                        yield self.done(list(reached), "timeout")
                    self.parts.removeKey(piece)
                else:
                    oldest = piece[1] if oldest is None else min(oldest, piece[1])
        if oldest is not None:
            self.numbers.update((number,))
            self.wake(oldest + self.width + self.within - 1)
        elif self.numbers.exists():
            self.numbers.clear()

    def out(self, key, rows):
        for frame in super().out(key, rows):
            yield frame.astype(dict.fromkeys(self.columns[len(self.keys) : -1], "Int64"))


def match_sequence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    steps: Sequence[tuple[str, Column]],
    within: str,
    contiguity: str | Sequence[str] = NEXT,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """``operators.patterns.match_sequence`` on a stream: steps linked by ``next`` or ``followed_by``, all less than
    ``within`` after the first; ``patterns.times`` gives repeated steps.

    Result: keys, per step a struct of ``ts`` and ``seq``, and ``route``: ``match``, told with the slot of the last
    step, or ``timeout`` for a start whose time ran out, told when the watermark has passed its slot by ``within``.
    With ``next``, rows that fit no step count as successors too.
    """
    links = [contiguity] * (len(steps) - 1) if isinstance(contiguity, str) else list(contiguity)
    if len(links) != len(steps) - 1 or set(links) - {NEXT, FOLLOWED_BY}:
        raise ValueError("contiguity must name next or followed_by for each link")
    if NEXT not in links:
        fits = steps[0][1]
        for _, condition in steps[1:]:
            fits = fits | condition
        df = df.where(fits)
    names = [name for name, _ in steps]
    bits = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(steps):
        bits = bits + F.when(_flag(condition), F.lit(1 << i)).otherwise(0)
    slots = _slotted(df, keys, ts, seq, slot, fits=bits)
    parts = [F.col(f"rows.{c}").alias(c) for c in ("us", "seq", "fits")]
    kinds = ", ".join(f"`{n}_{c}` long" for n in names for c in ("us", "seq"))
    found = slots.select(*keys, SLOT, AT, *parts).groupBy(*keys).transformWithStateInPandas(
        _Matcher(keys, names, links, micros(within), micros(slot)), f"{_kinds(df, keys)}, {kinds}, route string", "append", "EventTime"
    )
    reached = [
        F.when(
            F.col(f"{n}_us").isNotNull(),
            F.struct(F.timestamp_micros(f"{n}_us").alias(ts), F.col(f"{n}_seq").alias(seq)),
        ).alias(n)
        for n in names
    ]
    return found.select(*keys, *reached, "route")


def followed_by(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, first: Column, second: Column, within: str, slot: str = DEFAULT_SLOT
) -> DataFrame:
    """Two relaxed steps: keys, first_ts, first_seq, second_ts, second_seq, route."""
    found = match_sequence(df, keys, ts, seq, [("first", first), ("second", second)], within, FOLLOWED_BY, slot)
    parts = [F.col(f"{n}.`{c}`").alias(f"{n}_{a}") for n in ("first", "second") for c, a in ((ts, "ts"), (seq, "seq"))]
    return found.select(*keys, *parts, "route")
