"""Order and payment rules: one outcome per order, decided from event times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.time import micros

# fixed values: outcome texts
PAID = "paid ok"
PAID_LATE = "paid but timeout"
UNPAID = "order timeout"
NO_CREATE = "paid but not found create log"
WARN_PAID = "order paid ok"
WARN_UNPAID = "order timeout"


def _first_times(df: DataFrame, keys: Sequence[str], ts: str, is_create: Column, is_pay: Column) -> DataFrame:
    return (
        df.where(is_create | is_pay)
        .groupBy(*keys)
        .agg(
            F.min(F.when(is_create, F.col(ts))).alias("create_ts"),
            F.min(F.when(is_pay, F.col(ts))).alias("pay_ts"),
        )
    )


def order_match(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    is_create: Column,
    is_pay: Column,
    threshold: str = "120 seconds",
    disorder: str = "0 seconds",
) -> DataFrame:
    """Match each order's first create with its first pay.

    Paid strictly before create + ``threshold`` is ``paid ok`` on the main route; everything else
    goes to the side: paid at or after the deadline, never paid, or paid without a create. A pay
    stamped up to ``disorder`` before its create still counts as its payment.

    Two conditional minima per order: a partial aggregate, whatever the number of events per order.
    """
    wait = F.unix_micros("pay_ts") - F.unix_micros("create_ts")
    outcome = (
        F.when(F.col("create_ts").isNull() | (wait < -micros(disorder)), NO_CREATE)
        .when(F.col("pay_ts").isNull(), UNPAID)
        .when(wait < micros(threshold), PAID)
        .otherwise(PAID_LATE)
    )
    return (
        _first_times(df, keys, ts, is_create, is_pay)
        .withColumn("msg", outcome)
        .withColumn("route", F.when(F.col("msg") == PAID, "main").otherwise("side"))
    )


def order_warning(
    df: DataFrame, keys: Sequence[str], ts: str, is_create: Column, is_pay: Column, threshold: str = "120 seconds"
) -> DataFrame:
    """One message per created order when create + ``threshold`` is reached: paid by then or not.

    An order paid before it was created sets no alarm and gets no message.
    """
    wait = F.unix_micros("pay_ts") - F.unix_micros("create_ts")
    return (
        _first_times(df, keys, ts, is_create, is_pay)
        .where(F.col("create_ts").isNotNull() & (F.col("pay_ts").isNull() | (wait >= 0)))
        .withColumn("msg", F.when(wait <= micros(threshold), WARN_PAID).otherwise(WARN_UNPAID))
    )
