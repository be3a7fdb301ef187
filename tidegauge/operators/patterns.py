"""Sequence patterns with a time limit, matched by window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import floor_micros, micros
from tidegauge.operators.timeline import DEFAULT_SLOT, SLOT, carry_over, in_slot, on_timeline, with_slot

NEXT = "next"
FOLLOWED_BY = "followed_by"


def times(name: str, condition: Column, n: int) -> list[tuple[str, Column]]:
    """Steps for ``n`` rows in turn that fit ``condition``, named ``name`` with 1 to ``n`` behind."""
    return [(f"{name}{i + 1}", condition) for i in range(n)]


def match_sequence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    steps: Sequence[tuple[str, Column]],
    within: str,
    contiguity: str | Sequence[str] = NEXT,
    columns: Sequence[str] | None = None,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Match ``steps`` (name, condition) per key in event-time order.

    ``next`` asks for the immediate successor, ``followed_by`` for the first later row that fits;
    give one for all links or one per link. Every row fitting the first step starts its own match,
    so matches may overlap. All steps must lie less than ``within`` after the first.

    Result: keys, one struct per step, and ``route``: ``match``, or ``timeout`` for a start whose
    time ran out before the sequence was complete (the steps it did reach are filled). A start
    cut off by a wrong successor in time is dropped.

    Steps are linked from the last to the first. Walking a slot backwards, the nearest later match
    of the following step is a running ``last``; beyond the slot it comes from the carried table,
    so neither a hot key nor a long ``within`` puts a key's history into one task.
    """
    links = [contiguity] * (len(steps) - 1) if isinstance(contiguity, str) else list(contiguity)
    if len(links) != len(steps) - 1 or set(links) - {NEXT, FOLLOWED_BY}:
        raise ValueError("contiguity must name next or followed_by for each link")
    names = [name for name, _ in steps]
    columns = list(columns or [c for c in df.columns if c not in keys])
    if ts not in columns:
        columns.append(ts)

    at = F.struct(F.col(ts), F.col(seq))
    backward = in_slot(keys, F.col(ts).desc(), F.col(seq).desc())
    later = backward.rowsBetween(Window.unboundedPreceding, -1)

    line = with_slot(on_timeline(df, keys, ts), ts, slot)
    fits = [condition.alias(f"__fits{i}") for i, (_, condition) in enumerate(steps)]
    line = line.select(*keys, ts, seq, SLOT, F.struct(*columns).alias("__row"), *fits)
    final = len(steps) - 1
    line = line.withColumn(
        "__chain",
        F.when(
            F.col(f"__fits{final}"),
            F.struct(
                F.col("__row").alias(names[final]), F.col(ts).alias("__end"), F.lit(None).cast("timestamp").alias("__broke")
            ),
        ),
    )
    for i in range(final - 1, -1, -1):
        if links[i] == FOLLOWED_BY:
            line = line.withColumn("__local", F.last("__chain", True).over(later))
            line = carry_over(
                line,
                keys,
                {"__first": F.min_by("__chain", F.when(F.col("__chain").isNotNull(), at))},
                lambda per_slot, earlier: per_slot.select(*keys, SLOT, F.last("__first", True).over(earlier).alias("__far")),
                reverse=True,
            )
            line = line.withColumn("__link", F.coalesce("__local", "__far"))
            broke = F.col("__link.__broke")
        else:
            line = line.withColumn("__here", F.struct(F.col(ts).alias("at"), F.col("__chain").alias("chain")))
            line = line.withColumn("__local", F.lag("__here").over(backward))
            line = carry_over(
                line,
                keys,
                {"__first": F.min_by("__here", at)},
                lambda per_slot, earlier: per_slot.select(*keys, SLOT, F.last("__first").over(earlier).alias("__far")),
                reverse=True,
            )
            line = line.withColumn("__near", F.coalesce("__local", "__far")).withColumn("__link", F.col("__near.chain"))
            broke = F.when(F.col("__link").isNull(), F.col("__near.at")).otherwise(F.col("__link.__broke"))
        chain = F.struct(
            F.col("__row").alias(names[i]),
            *[F.col(f"__link.{n}").alias(n) for n in names[i + 1 :]],
            F.col("__link.__end").alias("__end"),
            broke.alias("__broke"),
        )
        line = line.withColumn("__chain", F.when(F.col(f"__fits{i}"), chain)).select(
            *keys, ts, seq, SLOT, "__row", "__chain", *[f"__fits{k}" for k in range(i)]
        )

    begin, limit = F.unix_micros(F.col(ts)), micros(within)

    def in_time(when: Column) -> Column:
        return F.coalesce(F.unix_micros(when) - begin < limit, F.lit(False))

    route = F.when(in_time(F.col("__chain.__end")), "match").when(~in_time(F.col("__chain.__broke")), "timeout")
    reached = [F.when(in_time(F.col(f"__chain.{n}.{ts}")), F.col(f"__chain.{n}")).alias(n) for n in names]
    return line.where("__chain is not null").select(*keys, *reached, route.alias("route")).where("route is not null")


def match_any(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    steps: Sequence[tuple[str, Column]],
    within: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every way to go through ``steps`` (name, condition) per key: each step any later row that fits, not just
    the first, all less than ``within`` after the first. Rows of one time follow each other by ``seq``.

    Result: keys and one struct per step, a row per match; starts without a match give none. Rows without key or
    time take no part.

    Steps are joined one after the other on (keys, time bucket), with buckets as wide as ``within``: what is begun
    goes to the one or two buckets its next step can be in, and a hot key is spread along its history. Only
    matches in the making are shuffled, with the columns asked for.
    """
    width = micros(within)
    names = [name for name, _ in steps]
    columns = list(columns or [c for c in df.columns if c not in keys])
    line = on_timeline(df, keys, ts).withColumn("__us", F.unix_micros(F.col(ts))).withColumn("__seq", F.col(seq))
    row = F.struct(*columns)
    found = line.where(steps[0][1]).select(*keys, row.alias(names[0]), F.col("__us").alias("__start"), "__us", "__seq")
    for i, (name, condition) in enumerate(steps[1:], 1):
        step = line.where(condition).select(
            *[F.col(k).alias(f"__key{n}") for n, k in enumerate(keys)],
            row.alias(name),
            F.col("__us").alias("__at"),
            F.col("__seq").alias("__next"),
            floor_micros(F.col("__us"), width).alias("__in"),
        )
        ends = [floor_micros(c, width) for c in (F.col("__us"), F.col("__start") + (width - 1))]
        begun = found.withColumn("__bucket", F.explode(F.sequence(*ends, F.lit(width))))
        same = F.col("__bucket") == F.col("__in")
        for n, k in enumerate(keys):
            same = same & (F.col(k) == F.col(f"__key{n}"))
        later = (F.col("__at") > F.col("__us")) | ((F.col("__at") == F.col("__us")) & (F.col("__next") > F.col("__seq")))
        pairs = begun.join(step, same & later & (F.col("__at") - F.col("__start") < width))
        found = pairs.select(
            *keys, *names[: i + 1], "__start", F.col("__at").alias("__us"), F.col("__next").alias("__seq")
        )
    return found.select(*keys, *names)
