"""Topic sink. Needs the Kafka connector package on the cluster's class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.session import checkpoint_dir
from tidegauge.sources.text import read_lines


def kafka_payload(df: DataFrame, key: str | None = None, cols: Sequence[str] | None = None, name: str = "") -> DataFrame:
    """Records rendered as ``Name(a,b,c)`` text in ``value``, optionally keyed."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols or df.columns]
    value = F.concat(F.lit(f"{name}("), F.concat_ws(",", *fields), F.lit(")")).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def kafka_sink(payload: DataFrame, servers: str, topic: str, checkpoint: str | None = None) -> StreamingQuery | None:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not payload.isStreaming:
        payload.write.format("kafka").options(**options).save()
        return None
    where = checkpoint or f"{checkpoint_dir(payload.sparkSession)}/topic-{topic}"
    return payload.writeStream.format("kafka").options(**options).option("checkpointLocation", where).start()


def publish_lines(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Publish a file's lines, one record each, straight from the tasks reading them."""
    kafka_sink(read_lines(spark, path).select("value"), servers, topic)
