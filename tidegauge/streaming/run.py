"""Starting streams: checkpoint, trigger and replay-safe sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.operators import ranking
from tidegauge.session import checkpoint_dir
from tidegauge.sinks.files import write_documents
from tidegauge.sinks.jdbc import upsert_jdbc
from tidegauge.sinks.tables import append_table, exists, expire, read_table

# fixed value: how often a long-running job checkpoints
CHECKPOINT_EVERY = "60 seconds"
CLOSING = "2200-01-01"  # later than any row's time


def writer(df: DataFrame, name: str, mode: str = "append", every: str | None = CHECKPOINT_EVERY) -> DataStreamWriter:
    """Stream writer with a checkpoint of its own under the shared folder.

    ``every`` is the trigger interval; None handles all data there is now and stops. Micro-batches
    replay from the checkpoint after a failure, so with the sinks below each result is kept once.
    """
    stream = df.writeStream.queryName(name).outputMode(mode)
    stream = stream.trigger(processingTime=every) if every else stream.trigger(availableNow=True)
    return stream.option("checkpointLocation", f"{checkpoint_dir(df.sparkSession)}/streams/{name}")


def closable(rows: DataFrame, ts: str, folder: str, **values: str) -> tuple[DataFrame, Callable[[], None]]:
    """``rows`` with a closing row to come from ``folder``, and the function that sends it.

    A bounded stream ends with the watermark at its newest row, and what is open there is never told.
    Call the function when the stream has read everything, and start it again from its checkpoint: the
    closing row takes the watermark past all that is open. The watermark never passes that row itself,
    so windows in append mode and ``streaming.rules`` leave it out of their results. ``values`` are those
    of its columns by which a filter after this would drop it.
    """
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)

    def close() -> None:
        row = [F.lit(CLOSING if c == ts else values.get(c, "0")).cast(t).alias(c) for c, t in rows.dtypes]
        spark.range(0, 1, 1, 1).select(*row).write.mode("append").parquet(folder)

    return rows.unionByName(spark.readStream.schema(rows.schema).parquet(folder)), close


def to_parquet(df: DataFrame, name: str, path: str, every: str | None = CHECKPOINT_EVERY) -> StreamingQuery:
    return writer(df, name, "append", every).format("parquet").option("path", path).start()


def each_batch(
    df: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "append",
    every: str | None = CHECKPOINT_EVERY,
) -> StreamingQuery:
    return writer(df, name, mode, every).foreachBatch(write).start()


def batches_to_parquet(df: DataFrame, name: str, path: str, mode: str = "update", every: str | None = CHECKPOINT_EVERY,
                       shape: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> StreamingQuery:
    """Store each micro-batch in its own folder, which a replay replaces."""
    return each_batch(
        df, name, lambda batch, i: shape(batch).write.mode("overwrite").parquet(f"{path}/batch={i}"), mode, every
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*")


def top_n_to_parquet(
    counts: DataFrame, name: str, path: str, window_col: str, order_col: str, key: str, n: int,
    every: str | None = CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Top-N of streaming window counts.

    In append mode a window's counts all leave in the micro-batch whose watermark closes the
    window, so ranking each batch ranks whole windows, and with the batch plan: ``n`` rows per
    window and task are shuffled, and no list of a window's keys is built.
    """
    return batches_to_parquet(
        counts, name, path, "append", every, lambda batch: ranking.top_n(batch, window_col, order_col, key, n)
    )


def to_upsert_table(
    df: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    parts: int = 64, mode: str = "append", every: str | None = CHECKPOINT_EVERY, keep: int = 2,
) -> StreamingQuery:
    """Append each micro-batch's changes; of a part, its ``keep`` newest generations stay for readers."""

    def merge(batch: DataFrame, _: int) -> None:
        append_table(batch, path, keys, order, values, parts)
        expire(batch.sparkSession, path, keep)

    return each_batch(df, name, merge, mode, every)


def refined_top_n(
    counts: DataFrame, name: str, path: str, window_col: str, order_col: str, key: str, n: int, parts: int = 64,
    every: str | None = CHECKPOINT_EVERY, keep: int = 2,
) -> StreamingQuery:
    """A ranking that late rows still correct: counts leave with each micro-batch (update mode), and the table at
    ``path`` keeps the newest ``n`` ranks of each window, with the micro-batch that set them as ``version``.

    Counts only grow, so an entry outside the ranking can enter it only with a new count. The ranks of the windows
    that a micro-batch touches, ``n`` rows each, and its own counts are thus all it takes to rank anew: no count
    outside the ranking is kept, and no other window is looked at. Ranks are replaced, never removed.
    """

    def rank(batch: DataFrame, version: int) -> None:
        spark, fresh = batch.sparkSession, batch.select(window_col, order_col, key)
        if exists(spark, path):
            touched = fresh.select(window_col).distinct()
            # also those of a first attempt at this micro-batch: the larger count of a key is the newer
            ranks = read_table(spark, path)
            fresh = fresh.unionByName(ranks.join(touched, window_col, "left_semi").select(window_col, order_col, key))
        newest = fresh.groupBy(window_col, key).agg(F.max(order_col).alias(order_col))
        ranked = ranking.top_n(newest, window_col, order_col, key, n).withColumn("version", F.lit(version).cast("long"))
        append_table(ranked, path, [window_col, "rank"], ["version"], ["version", order_col, key], parts)
        expire(spark, path, keep)

    return each_batch(counts, name, rank, "update", every)


def to_jdbc(
    df: DataFrame, name: str, url: str, table: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    properties: dict[str, str] | None = None, every: str | None = CHECKPOINT_EVERY,
) -> StreamingQuery:
    return each_batch(
        df, name, lambda batch, _: upsert_jdbc(batch, url, table, keys, order, values, properties), "append", every
    )


def to_documents(
    df: DataFrame, name: str, path: str, mapping: Mapping[str, str], every: str | None = CHECKPOINT_EVERY
) -> StreamingQuery:
    return each_batch(df, name, lambda batch, i: write_documents(batch, path, mapping, i), "append", every)
