"""Near duplicates through bottom-k sketches.

One hash function maps shingles to 64-bit values. A document retains the ``k`` values that come first
in one order shared by all documents: rare ones before common ones (by a fixed table of counters), then
by hash. With k = n - ceil(t * n) + 1 of n values, two sets of Jaccard similarity t or more retain a
value in common, so no link can be lost; ordering common values last keeps their lists short.

Inverted lists of retained values give candidates. Documents with equal sets are one node. In a list,
the first few nodes are compared with all others; nodes found linked are then one component, and later
rounds (with eight times as many) compare only across components, so that a large group of near copies
costs a multiple of its size rather than its square. Sizes and places in the lists bound the overlap
from above; the bottom ``SKETCH`` hashes of both sets estimate the similarity of what is left, rejecting
six standard deviations below the threshold; the full sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import only_ids, small_batches, texts_of, written
from tidegauge.llm.components import components
from tidegauge.llm.words import shingle_sets

BITS, CHUNK = 20, 1 << 14  # counters, and how many of them travel in a row
SKETCH = 32
FIRST = 8  # nodes of a list that the first round compares with all others
HELD = 1 << 16  # pairs held before they are sent on
NO_ID = -(1 << 63)  # stands for a null doc_id


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    for batch in small_batches(batches, "text"):
        sets = shingle_sets(texts_of(batch.column("text")), words)
        yield batch, sets, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]


def _digests(words: int, marked: bool):
    """A row per document (with its mark, if they have one), and the task's counters of shingles in rows of
    their own."""

    def scan(batches):
        counts = np.zeros(1 << BITS, np.int64)
        for batch, sets, classes in _sets(batches, words):
            counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(classes, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                    *([batch.column("mark")] if marked else []),
                ],
                names=["doc_id", "class", "size", "sketch", "chunk", "counts", *(["mark"] if marked else [])],
            )
        if counts.any():
            parts = [counts[i : i + CHUNK].tobytes() for i in range(0, len(counts), CHUNK)]
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                 pa.array(range(n), pa.int32()), pa.array(parts, pa.binary()), *([pa.nulls(n, pa.binary())] if marked else [])],
                names=["doc_id", "class", "size", "sketch", "chunk", "counts", *(["mark"] if marked else [])],
            )

    return scan


DIGESTS = "doc_id long, class binary, size long, sketch binary, chunk int, counts binary"


def _rarity(rows: DataFrame) -> np.ndarray:
    """log2 of how many shingles fell on each counter; 2^BITS bytes, whatever the input."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, np.zeros(CHUNK, np.int64)
        for batch in batches:
            for c, part in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                chunk = c
                held += np.frombuffer(part, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([held.tobytes()])], ["chunk", "counts"])

    parts = rows.where("chunk is not null").select("chunk", "counts")
    sums = parts.groupBy("chunk").applyInArrow(total, "chunk int, counts binary").collect()
    counts = np.zeros(1 << BITS, np.int64)
    for chunk, part in sums:
        counts[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(part, np.int64)
    return np.log2(counts + 1).astype(np.uint8)


def _retained(words: int, part: int, whole: int, rarity: np.ndarray):
    def scan(batches):
        for batch, sets, classes in _sets(batches, words):
            kept = []
            for s in sets:
                k = len(s) - -(-len(s) * part // whole) + 1 if len(s) else 0
                order = np.lexsort((s, rarity[(s >> np.uint64(64 - BITS)).astype(np.int64)]))[:k]
                kept.append(s[order].view(np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(k) for k in kept]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(classes, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(kept))),
                ],
                names=["id", "class", "size", "retained"],
            )

    return scan


LIST = ["value", "place", "size", "node"]
LIST_SCHEMA = "value long, place int, size int, node long"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (value, node), those whose value another node has too, each once."""
    held, met = None, False  # the last row, and whether the one before it has its value
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        value, node = table.column("value").to_numpy(), table.column("node").to_numpy()
        same = value[1:] == value[:-1]
        new = np.flatnonzero(np.concatenate(([True], ~(same & (node[1:] == node[:-1])))))
        table, value = table.take(pa.array(new)), value[new]
        same = value[1:] == value[:-1]
        before, after = np.concatenate(([met], same)), np.concatenate((same, [False]))
        keep = before | after
        met, keep[-1] = bool(before[-1]), False
        yield from table.filter(pa.array(keep)).to_batches()
        held = table.slice(len(value) - 1).combine_chunks().to_batches()[0]
    if met:
        yield held


def _pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(found, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _candidates(begin: int, end: int, part: int, whole: int) -> Callable:
    """Pairs of a list's nodes number ``begin`` to ``end`` with all nodes after them, where components
    differ and sizes and places allow the threshold. Of a list, only its first ``end`` rows are held."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, seen = None, 0
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in (*LIST, "comp")]
            held = len(head[0]) if head else 0
            value, place, size, node, comp = [np.concatenate(x) for x in zip(head, new)] if head else new
            starts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(value))))
            offset = np.arange(len(value)) - starts[run]
            if held:
                offset[held:] += (seen - held) * (run[held:] == 0)
            size, place = size.astype(np.int64), place.astype(np.int64)
            alive = np.flatnonzero((offset > begin) & (np.arange(len(value)) >= held))
            found = []
            for d in range(begin, end):
                alive = alive[offset[alive] > d]
                if not len(alive):
                    break
                first = starts[run[alive]] + d
                n, m, i, j = size[first], size[alive], place[first], place[alive]
                # if this is the first value they share, no more than what follows it can be common
                overlap = np.minimum(n - i, m - j)
                fits = (comp[first] != comp[alive]) & (whole * np.minimum(n, m) >= part * np.maximum(n, m))
                fits &= (whole + part) * overlap >= part * (n + m)
                a, b = node[first[fits]], node[alive[fits]]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                if sum(x.shape[1] for x in found) > HELD:
                    yield _pairs(found)
                    found = []
            last = run == run[-1]
            seen = int(offset[-1]) + 1
            keep = last & (offset < end)
            head = [x[keep] for x in (value, place, size, node, comp)]
            if found:
                yield _pairs(found)

    return scan


def _hashes(column: pa.Array) -> list[np.ndarray]:
    """A binary column as arrays of 64-bit hashes, without copying it."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return [data[a:b].view(np.uint64) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _similar(part: int, whole: int, exact: bool) -> Callable:
    """Pairs whose sets (or, estimated, whose sketches) are similar enough."""
    t = part / whole
    least = t - 6 * np.sqrt(t * (1 - t) / SKETCH)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_hashes(batch.column("left")), _hashes(batch.column("right"))):
                both = np.intersect1d(x, y, assume_unique=True)
                if exact:
                    keep.append(whole * len(both) >= part * (len(x) + len(y) - len(both)))
                else:
                    union = np.union1d(x, y)[:SKETCH]
                    # a sketch of fewer values is the whole set
                    shared = np.isin(union, both, assume_unique=True).sum()
                    keep.append(shared >= least * len(union))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return scan


def _decided(pairs: DataFrame, sets: DataFrame, column: str, part: int, whole: int, exact: bool) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col(column).alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col(column).alias("right"))
    return pairs.join(right, "b").join(left, "a").mapInArrow(_similar(part, whole, exact), "a long, b long")


def _full_sets(words: int):
    """Sets of nodes; of rows that share an id, only those with the node's text."""

    def scan(batches):
        for batch, sets, classes in _sets(batches, words):
            mine = [i for i, c in enumerate(batch.column("class").to_pylist()) if c == classes[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(mine, pa.int64())),
                    pa.array([sets[i].tobytes() for i in mine], pa.binary()),
                ],
                names=["node", "whole"],
            )

    return scan


def _grouped(docs: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Each row's doc_id, n_shingles, class (null without words), root and component_id, both null with class;
    and its mark, if ``docs`` (doc_id, text) has one."""
    marked = "mark" in docs.columns
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    digests = docs.mapInArrow(_digests(words, marked), DIGESTS + ", mark binary" * marked)
    found = written(digests, "shingles")
    rows = found.where("chunk is null").select("doc_id", "class", F.col("size").alias("n_shingles"), *["mark"] * marked)
    rarity = spark.sparkContext.broadcast(_rarity(found))  # 2^BITS bytes
    known = found.where("class is not null").groupBy("class")
    known = known.agg(F.min("doc_id").alias("first_id"), F.min("sketch").alias("sketch"))
    nodes = written(known.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = nodes.select("class", "node", F.coalesce("first_id", F.lit(NO_ID)).alias("id"))
    texts = texts.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))

    def retained(batches):
        return _retained(words, part, whole, rarity.value)(batches)

    kept = texts.select("id", "text").mapInArrow(retained, "id long, class binary, size int, retained array<long>")
    lists = kept.join(keys, ["id", "class"]).select("node", "size", F.posexplode("retained").alias("place", "value"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = lists.select(*LIST).repartition(tasks, "value").sortWithinPartitions("value", "node")
    lists = written(lists.mapInArrow(_shared, LIST_SCHEMA), "lists")

    comps, begin, end = None, 0, FIRST
    open_ = lists.withColumn("comp", F.col("node"))
    while True:
        members = open_.repartition(tasks, "value").sortWithinPartitions("value", "node")
        pairs = members.mapInArrow(_candidates(begin, end, part, whole), "a long, b long").distinct()
        close = written(_decided(pairs, nodes, "sketch", part, whole, False), "close")
        ends = close.select(F.col("a").alias("node")).union(close.select("b")).distinct()
        wanted = written(keys.join(ends, "node"), "wanted")
        sets = only_ids(texts.select("id", "text"), wanted, "id").join(wanted, "id").select("node", "class", "text")
        sets = written(sets.mapInArrow(_full_sets(words), "node long, whole binary"), "sets")
        links = _decided(close, sets, "whole", part, whole, True)
        if comps is not None:
            links = links.union(comps.select("node", "root"))
        comps = components(links)
        members = open_.drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node"))
        mixed = members.groupBy("value").agg(F.count("*").alias("n"), F.min("comp").alias("p"), F.max("comp").alias("q"))
        mixed = mixed.where((F.col("n") > end) & (F.col("p") < F.col("q"))).select("value")
        open_ = written(members.select(*LIST, "comp").join(mixed, "value", "left_semi"), "open")
        if open_.isEmpty():
            break
        begin, end = end, end * 8
    roots = nodes.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = written(roots.select("class", "first_id", "root"), "roots")
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(smallest, "root").select("class", "root", "component_id")
    return rows.join(named, "class", "left")


def near_groups(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """Each row's component of documents linked by ``whole`` * intersection >= ``part`` * union of their
    sets of ``words``-word shingles.

    Result: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id).
    Documents without words are linked with nothing. Rows with a null doc_id take part; they get their
    component's smallest doc_id, null if it has none, and are kept in that case only. Rows that repeat
    a doc_id are linked by their texts, not by the id.
    """
    out = _grouped(docs.select("doc_id", "text"), words, part, whole)
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def near_dedup(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: one of the smallest doc_id, or without doc_id
    if no row of the group has one. Of rows that share that doc_id, the one of the smallest mark (a digest
    of all columns) stays. All rows without words stay."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    mark = F.concat(F.md5(F.coalesce("text", F.lit(""))), F.to_json(F.struct(F.col("text").isNull().alias("none"), *others)))
    docs = docs.withColumn("__mark", F.unhex(F.md5(mark)))
    rows = _grouped(docs.select("doc_id", "text", F.col("__mark").alias("mark")), words, part, whole)
    wordless = rows.where("class is null").select(F.col("mark").alias("__mark"))
    first = rows.where("class is not null and doc_id <=> component_id").groupBy("root").agg(F.min("mark").alias("__mark"))
    out = docs.join(first.select("__mark"), "__mark", "left_semi").dropDuplicates(["__mark"])
    return out.unionByName(docs.join(wordless, "__mark", "left_semi")).drop("__mark")
