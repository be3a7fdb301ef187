"""Joining two event tables on a key and a time interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.time import floor_micros, micros


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lts: str,
    rts: str,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    how: str = "inner",
) -> DataFrame:
    """Pairs with ``lts + lower <= rts <= lts + upper`` as (keys, ``left`` struct, ``right`` struct).

    ``full_outer`` also returns left rows and right rows without a partner, the other struct null.

    The join key is (key, time bucket) with buckets as wide as the interval: each right row is sent
    to the at most two buckets its partners can be in. A hot key thus spreads over its whole
    history, and a row meets only rows near it in time.
    """
    if how not in ("inner", "full_outer"):
        raise ValueError(f"unknown how {how!r}")
    low, high = micros(lower), micros(upper)
    width = max(high - low, 1_000_000)

    def side(df: DataFrame, ts: str, name: str, since: int | None, until: int | None) -> DataFrame:
        at = F.unix_micros(F.col(ts))
        if since is None:
            bucket = floor_micros(at, width)
        else:
            bucket = F.explode(
                F.sequence(floor_micros(at + since, width), floor_micros(at + until, width), F.lit(width))
            )
        return df.select(
            *[F.col(k).alias(f"__{name}_{k}") for k in keys],
            F.struct(*df.columns).alias(name),
            at.alias(f"__{name}_at"),
            bucket.alias(f"__{name}_bucket"),
        )

    def near():
        gap = F.col("__right_at") - F.col("__left_at")
        same = F.col("__left_bucket") == F.col("__right_bucket")
        for k in keys:
            same = same & (F.col(f"__left_{k}") == F.col(f"__right_{k}"))
        return same & gap.between(low, high)

    placed = side(left, lts, "left", None, None)
    spread = side(right, rts, "right", -high, -low)
    pairs = placed.join(spread, near(), "inner" if how == "inner" else "left").select(
        *[F.col(f"__left_{k}").alias(k) for k in keys], "left", "right"
    )
    if how == "inner":
        return pairs
    # a right row has copies above, so its lack of a partner is asked with the roles swapped
    alone = side(right, rts, "right", None, None).join(side(left, lts, "left", low, high), near(), "left_anti")
    nothing = F.lit(None).cast(pairs.schema["left"].dataType)
    return pairs.unionByName(
        alone.select(*[F.col(f"__right_{k}").alias(k) for k in keys], nothing.alias("left"), "right")
    )
