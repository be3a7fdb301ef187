"""Counts and averages without windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, text: str = "value", keep_empty: bool = True) -> DataFrame:
    """One row per word, split at single spaces; batch counting keeps the empty words."""
    exploded = df.select(F.explode(F.split(F.col(text), " ")).alias("word"))
    return exploded if keep_empty else exploded.where("word <> ''")


def word_count(df: DataFrame, text: str = "value", keep_empty: bool = True) -> DataFrame:
    return words(df, text, keep_empty).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def avg_int_div(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Sum of whole numbers divided by their count as whole numbers, then widened: 7/2 -> 3.0. The sum
    is a decimal, so it does not overflow a long."""
    return df.groupBy(*keys).agg(
        F.expr(f"cast(sum(cast(`{col}` as decimal(20,0))) div count(`{col}`) as double)").alias("average")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Values of each key's last row; a partial aggregate, so no row list per key is built."""
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    newest = F.max_by(F.struct(*values), by)
    return df.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*")
