"""Top-N per window and the text report made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import epoch_text


def top_n(counts: DataFrame, window_col: str, order_col: str, key: str, n: int) -> DataFrame:
    """The ``n`` largest rows per window, ties by ascending key, with their ``rank``.

    The rank filter lets Spark keep only ``n`` rows per window on the map side, before the
    exchange, so a window with a billion keys still sends ``n`` rows per task.
    """
    by_size = Window.partitionBy(window_col).orderBy(F.col(order_col).desc(), F.col(key).asc())
    return counts.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= n)


# fixed values: wording of the report
TIME_LABEL = "时间: "
COUNT_LABEL = " 数量="
ITEM_LABEL = " 商品Id="
URL_LABEL = " Url="


def report_text(
    top: DataFrame, window_col: str, order_col: str, key: str, label: str = ITEM_LABEL
) -> DataFrame:
    """One text block per window from ``top_n`` output; a group holds at most ``n`` rows."""
    entries = F.sort_array(
        F.collect_list(
            F.struct(
                F.col("rank"),
                F.concat(
                    F.lit("No."),
                    F.col("rank").cast("string"),
                    F.lit(":" + label),
                    F.col(key).cast("string"),
                    F.lit(COUNT_LABEL),
                    F.col(order_col).cast("string"),
                    F.lit("\n"),
                ).alias("line"),
            )
        )
    )
    return (
        top.groupBy(window_col)
        .agg(entries.alias("entries"))
        .select(
            window_col,
            F.concat(
                F.lit(TIME_LABEL), epoch_text(F.col(window_col)), F.lit("\n"), F.array_join("entries.line", "")
            ).alias("report"),
        )
    )
