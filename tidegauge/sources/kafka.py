"""Topic source. Needs the Kafka connector package on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, group: str | None = None, offsets: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(df: DataFrame) -> DataFrame:
    """Record values as text, column ``value`` like a text file's lines."""
    return df.select(F.col("value").cast("string").alias("value"))


def kafka_source(
    spark: SparkSession, servers: str, topic: str, group: str | None = None, offsets: str = "latest"
) -> DataFrame:
    return kafka_lines(spark.readStream.format("kafka").options(**kafka_options(servers, topic, group, offsets)).load())
