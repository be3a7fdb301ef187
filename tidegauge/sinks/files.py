"""Text, document and console sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tuple_text(df: DataFrame) -> DataFrame:
    """Rows as ``(a,b,...)`` in one text column."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with rows as tuple text. A folder of part files: one writer per task."""
    tuple_text(df).write.mode("overwrite").text(path)


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.select(F.lit(label).alias("label"), "*")


def show_labelled(df: DataFrame, label: str) -> StreamingQuery | None:
    """Print every row under a label, of a stream those of each micro-batch. Rows pass one partition
    after the other, so the driver holds no more than one."""

    def show(rows: DataFrame, _: int = 0) -> None:
        for row in tuple_text(rows).toLocalIterator():
            print(f"{label}> {row.value}")

    if df.isStreaming:
        return df.writeStream.outputMode("append").foreachBatch(show).start()
    show(df)
    return None


def documents(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """All-text documents; ``mapping`` is document field -> column."""
    return df.select(*[F.col(col).cast("string").alias(field) for field, col in mapping.items()])


def write_documents(df: DataFrame, path: str, mapping: Mapping[str, str], batch_id: int | None = None) -> None:
    """Append JSON documents under ``path``.

    With ``batch_id`` (from foreachBatch) the documents go to the folder of that batch, which a
    replay after a failure replaces, so no document is stored twice.
    """
    docs = documents(df, mapping)
    if batch_id is None:
        docs.write.mode("append").json(path)
    else:
        docs.write.mode("overwrite").json(f"{path}/batch={batch_id}")
