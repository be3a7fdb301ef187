"""Running per-key results: one output row per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.timeline import DEFAULT_SLOT, SLOT, carry_over, in_slot, on_timeline, with_slot


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    col: Column,
    name: str = "running",
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Running sum of ``col`` per key in (ts, seq) order. Rows without key or time take no part."""
    base = with_slot(on_timeline(df, keys, ts), ts, slot).withColumn("__v", col)
    upto = in_slot(keys, F.col(ts), F.col(seq)).rowsBetween(Window.unboundedPreceding, 0)
    joined = carry_over(
        base.withColumn("__local", F.sum("__v").over(upto)),
        keys,
        {"__sum": F.sum("__v")},
        lambda per_slot, earlier: per_slot.select(*keys, SLOT, F.sum("__sum").over(earlier).alias("__prior")),
    )
    total = F.when(F.col("__prior").isNull(), F.col("__local")).otherwise(F.col("__local") + F.col("__prior"))
    return joined.withColumn(name, total).drop(SLOT, "__v", "__local", "__prior")


def running_reduce(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    seq: str,
    add: float = 10,
    tick: int = 1,
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """Running fold of readings: time moves on by ``tick``, the value is the newest plus ``add``.

    ``ts`` is a timestamp; the output's ``epoch`` is the first reading's whole second plus ``tick``
    for each later one, and its ``result`` is raw for the first reading. The fold keeps nothing of
    the middle readings, so row number and first time describe it fully. Rows without key or time
    take no part.
    """
    base = with_slot(on_timeline(df, [key], ts), ts, slot)
    order = in_slot([key], F.col(ts), F.col(seq))
    at = F.struct(F.col(ts), F.col(seq))
    local = base.withColumn("__rn", F.row_number().over(order)).withColumn("__first", F.first(ts).over(order))
    joined = carry_over(
        local,
        [key],
        {"__rows": F.count(F.lit(1)), "__begin": F.min_by(ts, at)},
        lambda per_slot, earlier: per_slot.select(
            key,
            SLOT,
            F.sum("__rows").over(earlier).alias("__prior"),
            F.first("__begin").over(earlier).alias("__origin"),
        ),
    )
    n = F.col("__rn") + F.coalesce("__prior", F.lit(0))
    first_second = F.unix_seconds(F.coalesce("__origin", "__first"))
    return joined.select(
        key,
        seq,
        (first_second + (n - 1) * tick).alias("epoch"),
        F.when(n == 1, F.col(value)).otherwise(F.col(value) + F.lit(add)).alias("result"),
    )
