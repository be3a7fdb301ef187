"""Exact duplicates through an extendible-hash index kept in shared files.

A key is a text's 64-bit hash. The directory maps key prefixes to buckets; where a bucket would hold
more than ``capacity`` keys, it is split, and the directory doubles as far as the deepest bucket needs.
Owner tasks take key ranges (whole buckets), sort them, chain the texts of equal keys and compare their
bytes. What they write is the index, in files of the shared folder: which entry (bucket, key, place in the
chain) each text they were sent is. Rows find their group by that entry alone.

One text may make up a third of all rows: scanning tasks hand each distinct text on once per few
megabytes of them, rows carry a reference to it, and groups are counted from a partial sum per reference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import small_batches, texts_of, written

# fixed values: the white space that does not count
SPACES = b" \t\n\x0b\x0c\r"
TOP = 16  # prefix bits counted at first


def _keyed(raw: bytes) -> tuple[int, bytes]:
    text = raw.translate(None, SPACES)
    return xxhash.xxh64_intdigest(text) - (1 << 63), text


def _scanned(held: int = 32 << 20):
    """A row per document, with a reference to its text: of equal texts of a task, the first of each ``held`` bytes
    of distinct texts carries the text, the others its reference only."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        found: dict[bytes, int] = {}
        size = 0
        for batch in small_batches(batches, "text"):
            refs, keys, texts = [], [], []
            for raw in texts_of(batch.column("text")):
                key, text = _keyed(raw)
                ref = found.get(text)
                if ref is None:
                    ref = found[text] = part << 33 | number
                    number += 1
                    size += len(text) + 100
                    texts.append(text)
                else:
                    texts.append(None)
                refs.append(ref)
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("points"), pa.array(refs, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(texts, pa.binary())],
                names=["doc_id", "points", "ref", "key", "bare"],
            )
            if size > held:
                found, size = {}, 0

    return scan


def _placed(directory: np.ndarray, depth: int):
    """Texts with the bucket that owns their key."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            place = (keys.astype(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - depth) if depth else np.zeros(len(keys), int)
            bucket = pa.array(directory[place.astype(np.int64)], pa.int32())
            yield pa.RecordBatch.from_arrays([bucket, *batch.columns], names=["bucket", *batch.schema.names])

    return scan


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entry of each reference, of key ranges sorted by key: a chain of texts per key, told apart by their bytes."""
    last, chain = None, []
    for batch in small_batches(batches, "bare"):
        out = []
        for bucket, key, ref, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "ref", "bare"))):
            if key != last:
                last, chain = key, []
            slot = next((i for i, (known, _) in enumerate(chain) if known == text), len(chain))
            if slot == len(chain):
                chain.append((text, hashlib.sha256(text).hexdigest()))
            out.append((ref, bucket, key, slot, chain[slot][1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string()))],
            names=["ref", "bucket", "key", "slot", "text_sha256"],
        )


def directory_of(keys: DataFrame, capacity: int) -> tuple[np.ndarray, int]:
    """(bucket of each prefix, prefix bits). ``keys``: column key. The driver sees counts of prefixes
    only, about as many as there are buckets."""

    def counts(frame: DataFrame, bits: int) -> dict[int, int]:
        prefix = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)
        return {r[0]: r[1] for r in frame.groupBy(prefix.alias("p")).count().collect()}

    distinct = keys.select("key").distinct()
    bits = TOP
    leaf = counts(distinct, bits)
    while max(leaf.values(), default=0) > capacity and bits < 24:
        bits += 4
        leaf = counts(distinct, bits)
    total = np.zeros(1 << bits, np.int64)
    for p, n in leaf.items():
        total[p] = n
    buckets, depth = [], 0

    def split(low: int, level: int, size: int) -> None:
        nonlocal depth
        if level < bits and total[low : low + size].sum() > capacity:
            split(low, level + 1, size // 2)
            split(low + size // 2, level + 1, size // 2)
        else:
            buckets.append((low, size))
            depth = max(depth, level)

    split(0, 0, 1 << bits)
    directory = np.empty(1 << depth, np.int32)
    for number, (low, size) in enumerate(buckets):
        directory[low >> (bits - depth) : (low + size) >> (bits - depth)] = number
    return directory, depth


def exact_groups(docs: DataFrame, capacity: int = 50_000) -> DataFrame:
    """Each row's group of equal texts, white space aside.

    Result: doc_id, keep_id, group_size, kept, text_sha256, bucket. Of equal texts the row with the most
    code points stays, then the smallest doc_id (null last); of rows that agree in these too, one.
    Null text counts as empty. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("points"))
    rows = texts.mapInArrow(_scanned(), "doc_id long, points long, ref long, key long, bare binary")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")
    distinct = rows.where("bare is not null").select("key", "ref", "bare")
    directory, depth = directory_of(distinct, capacity)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-len(set(directory.tolist())) // 4))
    owned = (
        distinct.mapInArrow(_placed(directory, depth), "bucket int, key long, ref long, bare binary")
        .repartition(tasks, "bucket")
        .sortWithinPartitions("key")
        .mapInArrow(_own, "ref long, bucket int, key long, slot int, text_sha256 string")
    )
    index = written(owned, "index")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id", "row"))
    partial = rows.groupBy("ref").agg(best.alias("best"), F.count("*").alias("n"))
    entry = ["bucket", "key", "slot"]
    groups = index.join(partial, "ref").groupBy(*entry).agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))
    found = index.join(groups, entry).select("ref", "best", "group_size", "text_sha256", "bucket")
    return rows.select("doc_id", "row", "ref").join(found, "ref").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "bucket",
    )


def exact_dedup(docs: DataFrame, capacity: int = 50_000) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were. Rows that agree in
    doc_id and text are one document; one of them stays, whatever their other columns hold."""
    groups = exact_groups(docs.select("doc_id", "text"), capacity).where("kept")
    none = F.lit(-(1 << 63))
    stays = groups.select(F.coalesce("doc_id", none).alias("__id"), F.col("text_sha256").alias("__sha"))
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", none), "__sha": F.sha2(bare, 256)})
    first = Window.partitionBy("__id", "__sha").orderBy(F.length("text").desc_nulls_last())
    kept = keyed.join(stays, ["__id", "__sha"], "left_semi").withColumn("__n", F.row_number().over(first))
    return kept.where("__n = 1").drop("__id", "__sha", "__n").select(*docs.columns)
