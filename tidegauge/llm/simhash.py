"""SimHash near duplicates through tables of distances to pivots.

A fingerprint bit is the majority of that bit over the XXH64 values of a text's shingles. Fingerprints at
few differing bits are linked. Equal ones are one node, so copies cost nothing.

The table: Hamming distances of each fingerprint to ``PIVOTS`` reference fingerprints. By the triangle
inequality, two fingerprints at distance r differ by at most r in every coordinate; a pair with a larger
difference anywhere is discarded, and only what is left is compared itself. The table is filled where
it is used, 8 bytes a fingerprint being all that travels.

Which pairs look at their coordinates: fingerprints are dealt to cells. With ``bits`` differing bits and the
64 bits cut into ``bits + 1`` parts, one part is the same in both, so they meet in its cell. A cell of more
than ``most`` fingerprints is dealt again: the bits it has not fixed yet are cut likewise. Every level
leaves ``bits`` in ``bits + 1`` of the open bits, until no cell can be too full. So no link is lost, no cell is
unbounded, and one crowd of like fingerprints is spread over many tasks. Cells send a spanning forest of
their links, fewer than their members, and not the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import small_batches, texts_of, written
from tidegauge.llm.components import components
from tidegauge.llm.words import LOWER

SEED = 42  # fixed value: of the shingle hash
PIVOTS = 32
BLOCK = 1 << 16  # shingles hashed at a time
FULL = (1 << 64) - 1


def pivots() -> np.ndarray:
    """The reference fingerprints: the shingle hash of the first numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), seed=SEED) for i in range(PIVOTS)], np.uint64)


def fingerprint(text: bytes, words: int = 3) -> int:
    """The majority bits over all shingles of ``words`` words; A-Z count as a-z. Fewer words are one
    shingle, none give 0."""
    found = text.translate(LOWER).split()
    if not found:
        return 0
    n = max(len(found) - words + 1, 1)
    joined = b" ".join(found)
    ends = (np.cumsum([len(w) + 1 for w in found]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    ends, digest = ends[min(words, len(found)) - 1 :], xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        values = [digest(joined[a:b], SEED) for a, b in zip(starts[i : min(i + BLOCK, n)], ends[i : i + BLOCK])]
        bits = np.unpackbits(np.array(values, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = np.array([fingerprint(t, words) for t in texts_of(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return scan


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts(fixed: int, bits: int) -> list[int]:
    """Masks that fix one more part each: the bits not in ``fixed``, cut into ``bits + 1`` parts."""
    open_ = [1 << i for i in range(64) if not fixed >> i & 1]
    return [fixed | sum(p) for p in np.array_split(np.array(open_, object), bits + 1) if len(p)]


def _dealt(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each fingerprint in the cells of the masks that refine the one it is in."""
    finer: Column = F.lit(None).cast("array<long>")
    for mask, into in masks.items():
        finer = F.when(F.col("mask") == _signed(mask), F.array(*[F.lit(_signed(m)) for m in into])).otherwise(finer)
    rows = rows.select("print", F.explode(finer).alias("mask"))
    return rows.withColumn("cell", F.col("print").bitwiseAND(F.col("mask")))


def _links(bits: int):
    """Links of whole cells: rows come sorted by (mask, cell, first coordinate). Of each cell a spanning
    forest is sent. What is held is a batch and the cell it ends in."""
    table = pivots()

    def joined(cells: np.ndarray, prints: np.ndarray, first: np.ndarray) -> pa.RecordBatch | None:
        coordinates = np.bitwise_count(prints[:, None] ^ table).astype(np.int8)
        run = np.cumsum(np.concatenate(([0], (cells[1:] != cells[:-1]).any(axis=1))))
        root, alive, d = np.arange(len(prints)), np.arange(len(prints)), 0
        while True:
            d += 1
            alive = alive[alive + d < len(prints)]
            # the first coordinate grows inside a cell, so what is too far now stays so
            alive = alive[(run[alive + d] == run[alive]) & (first[alive + d] - first[alive] <= bits)]
            if not len(alive):
                break
            near = alive[root[alive] != root[alive + d]]  # the others are connected already
            near = near[(np.abs(coordinates[near] - coordinates[near + d]) <= bits).all(axis=1)]
            near = near[np.bitwise_count(prints[near] ^ prints[near + d]) <= bits]
            while len(near):
                a, b = root[near], root[near + d]
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while (root[root] != root).any():
                    root = root[root]
                near = near[root[near] != root[near + d]]
        ends = np.flatnonzero(root != np.arange(len(root)))
        if not len(ends):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[ends].view(np.int64)), pa.array(prints[root[ends]].view(np.int64))], ["a", "b"]
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ("mask", "cell", "print", "first")]
            columns = [np.concatenate(x) for x in zip(held, new)] if held else new
            mask, cell = columns[:2]
            cut = np.flatnonzero((mask != mask[-1]) | (cell != cell[-1]))
            cut = cut[-1] + 1 if len(cut) else 0
            whole, held = [x[:cut] for x in columns], [x[cut:] for x in columns]
            if cut:
                out = joined(np.stack(whole[:2], axis=1), whole[2].view(np.uint64), whole[3])
                if out:
                    yield out
        if held:
            out = joined(np.stack(held[:2], axis=1), held[2].view(np.uint64), held[3])
            if out:
                yield out

    return scan


def print_links(prints: DataFrame, bits: int = 2, most: int = 2048) -> DataFrame:
    """(a, b): links that connect what lies at ``bits`` or fewer differing bits among the distinct
    ``prints`` (column print); every such pair is connected by a path of them. ``most`` is raised to what a
    cell can hold when fewer than 2 * ``bits`` + 2 bits are open."""
    most = max(most, 1 << (2 * bits + 2))
    first = F.bit_count(F.col("print").bitwiseXOR(F.lit(_signed(int(pivots()[0])))))
    rows, level, out = prints.select("print", F.lit(0).cast("long").alias("mask")), [0], None
    while True:
        masks = {mask: parts(mask, bits) for mask in level}
        level = [m for finer in masks.values() for m in finer]
        cells = written(_dealt(rows, masks), "cells")
        tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        open_ = 64 - max(m.bit_count() for m in level)
        crowded = None
        if 1 << open_ > most:
            crowded = cells.groupBy("mask", "cell").count().where(F.col("count") > most).select("mask", "cell")
            crowded = written(crowded, "crowded")
            crowded = None if crowded.isEmpty() else crowded
        small = cells if crowded is None else cells.join(crowded, ["mask", "cell"], "left_anti")
        dealt = small.withColumn("first", first).repartition(tasks, "mask", "cell")
        found = dealt.sortWithinPartitions("mask", "cell", "first").mapInArrow(_links(bits), "a long, b long")
        found = written(found, "print_links")
        out = found if out is None else out.union(found)
        if crowded is None:
            return out
        rows = cells.join(crowded, ["mask", "cell"], "left_semi").select("print", "mask")


def simhash_groups(docs: DataFrame, words: int = 3, bits: int = 2, most: int = 2048) -> DataFrame:
    """Each row's fingerprint and its component of fingerprints linked at ``bits`` or fewer differing bits.

    Result: doc_id, fingerprint (16 lower-case hex digits), component_id (smallest doc_id reachable). Null
    text is empty; texts without words have fingerprint 0, which is linked like any other. Rows with a null
    doc_id take part; a component without any doc_id has a null component_id. Rows that repeat a doc_id are
    linked by their fingerprints, not by the id. Other columns are ignored; an empty table gives no rows.
    """
    rows = written(docs.select("doc_id", "text").mapInArrow(_fingerprints(words), "doc_id long, print long"), "prints")
    nodes = written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct_prints")
    comps = components(print_links(nodes, bits, most))
    roots = nodes.join(comps.withColumnRenamed("node", "print"), "print", "left")
    roots = roots.withColumn("root", F.coalesce("root", "print"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(smallest, "root").select("print", "component_id")
    return rows.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )

