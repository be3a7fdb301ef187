"""Ordered per-key work that survives a hot key.

``Window.partitionBy(key)`` puts a key's whole history into one task. Where one key may hold a
third of all rows that task never ends. The operators here cut every key's timeline into slots
of fixed width, run their window functions inside ``(key, slot)``, and bring in what earlier
slots know through a small table with one row per ``(key, slot)``:

    rows  --hash(key, slot)-->  local window functions  --\
                                                            join on (key, slot) --> combine
    rows  --partial agg--> one row per (key, slot) --hash(key)--> running window over slots --/

Full rows are shuffled once, on ``(key, slot)``, and the join reuses that partitioning and sort
order. The per-slot table has as many rows per key as the key has busy slots, which the calendar
bounds (about 52,000 ten-minute slots a year), not the row count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions.time import bucket_start, micros

SLOT = "__slot"
DEFAULT_SLOT = "10 minutes"


def with_slot(df: DataFrame, ts: str, width: str = DEFAULT_SLOT) -> DataFrame:
    return df.withColumn(SLOT, bucket_start(F.col(ts), micros(width)))


def on_timeline(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows that have a key and a time; only they take part in runs and sequences.

    Spark adds this filter to the joined side anyway. Stating it for both sides makes their
    exchanges equal, and Spark then shuffles the rows once and reuses the files.
    """
    for name in (*keys, ts):
        df = df.where(F.col(name).isNotNull())
    return df


def in_slot(keys: Sequence[str], *order: Column) -> WindowSpec:
    return Window.partitionBy(*keys, SLOT).orderBy(*order)


def carry_over(
    df: DataFrame,
    keys: Sequence[str],
    summary: Mapping[str, Column],
    carried: Callable[[DataFrame, WindowSpec], DataFrame],
    reverse: bool = False,
) -> DataFrame:
    """Join to the slotted ``df`` what the slots before (``reverse``: after) each slot amount to.

    ``summary`` holds the aggregates describing one slot. ``carried`` gets the per-slot table and
    the window of all strictly earlier slots of the key, and returns keys, slot and the columns to
    join.
    """
    per_slot = df.groupBy(*keys, SLOT).agg(*[c.alias(n) for n, c in summary.items()])
    order = F.col(SLOT).desc() if reverse else F.col(SLOT).asc()
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(carried(per_slot, earlier), [*keys, SLOT], "left")


def carry_last(
    df: DataFrame, keys: Sequence[str], name: str, of: Column, order: Column, reverse: bool = False
) -> DataFrame:
    """Add ``name``: ``of`` from the last row (by ``order``) of the nearest earlier slot."""
    pick = F.min_by if reverse else F.max_by
    return carry_over(
        df,
        keys,
        {"__of": pick(of, order)},
        lambda per_slot, earlier: per_slot.select(*keys, SLOT, F.last("__of").over(earlier).alias(name)),
        reverse,
    )


def islands(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    row: Column,
    starts: Callable[[Column, Column], Column],
    slot: str = DEFAULT_SLOT,
) -> DataFrame:
    """(keys, ts, seq, fields of ``row``, ``run_start``): the (time, seq) that began each row's run.

    ``starts(previous, current)`` tells from two neighbouring ``row`` structs whether the current
    row begins a new run; a key's first row always does. Inside a slot that is a window function.
    The slot's leading rows, whose run may have begun earlier, take the start the slots before
    hand on.
    """
    at = F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"))
    order = in_slot(keys, F.col(ts), F.col(seq))
    # nothing but these columns, so that both sides of the join below share one exchange
    base = with_slot(on_timeline(df, keys, ts), ts, slot).select(*keys, ts, seq, SLOT, row.alias("__row"))
    marked = base.withColumn("__prev", F.lag("__row").over(order)).withColumn(
        "__local",
        F.last(F.when(F.col("__prev").isNotNull() & starts(F.col("__prev"), F.col("__row")), at), True).over(
            order.rowsBetween(Window.unboundedPreceding, 0)
        ),
    )

    def resolve(per_slot: DataFrame, earlier: WindowSpec) -> DataFrame:
        known = per_slot.withColumn("__before", F.last("__tail_row").over(earlier))
        opens = F.col("__before").isNull() | starts(F.col("__before"), F.col("__head_row"))
        opened = known.withColumn("__opened", F.when(opens, F.col("__head")))
        latest = F.coalesce(F.col("__tail"), F.col("__opened"))
        return opened.withColumn("__latest", latest).select(
            *keys, SLOT, F.coalesce("__opened", F.last("__latest", True).over(earlier)).alias("__inherited")
        )

    joined = carry_over(
        marked,
        keys,
        {
            "__head": F.min(at),
            "__head_row": F.min_by("__row", at),
            "__tail_row": F.max_by("__row", at),
            "__tail": F.max("__local"),
        },
        resolve,
    )
    return joined.select(*keys, ts, seq, "__row.*", F.coalesce("__local", "__inherited").alias("run_start"))

