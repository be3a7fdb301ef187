"""Helpers shared by the operators of this subpackage: tables, written intermediates, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# fixed values: the columns of the tables the queries read
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


BATCH = "4m"  # bytes that Spark puts into one Arrow batch, whole rows aside


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tidegauge-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    # a task holds several batches at a time, in the JVM and in Python
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds at most about ``limit`` bytes of ``text`` (or one row)."""
    for batch in batches:
        sizes = _sizes(batch.column(text))
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _sizes(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def texts_of(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


FILTER_BITS = 24  # a filter is 2^FILTER_BITS bits (2 MB), however many ids there are
_PIECE = 1 << 16


def _bit(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def only_ids(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` (long) is not in ``wanted``, before a join sends
    them around. A hashed bit per wanted id is shared with all tasks; the filter never drops a wanted
    row, and lets more others pass the more ids there are."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_bit(batch.column(column).to_numpy())] = True
        packed = np.packbits(bits)
        pieces = {i // _PIECE: packed[i : i + _PIECE].tobytes() for i in range(0, len(packed), _PIECE)}
        some = {i: p for i, p in pieces.items() if any(p)}
        yield pa.RecordBatch.from_arrays([pa.array(some.keys(), pa.int32()), pa.array(some.values(), pa.binary())], ["piece", "bits"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, bits = None, np.zeros(_PIECE, np.uint8)
        for batch in batches:
            for piece, part in zip(batch.column("piece").to_pylist(), batch.column("bits").to_pylist()):
                bits |= np.frombuffer(part, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([bits.tobytes()])], ["piece", "bits"])

    kind = "piece int, bits binary"
    found = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for piece, part in wanted.select(column).mapInArrow(marked, kind).groupBy("piece").applyInArrow(merged, kind).collect():
        found[piece * _PIECE : (piece + 1) * _PIECE] = np.frombuffer(part, np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _bit(batch.column(column).to_numpy())
            yield batch.filter(pa.array((shared.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1))

    return rows.mapInArrow(passed, rows.schema)
