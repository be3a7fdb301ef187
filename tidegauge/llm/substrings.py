"""Removal of repeated substrings by a difference-cover sample.

A string of ``length`` bytes that occurs twice need not be found at all of its positions. Modulo ``v``,
the residues of a difference cover contain every difference; so of two equal strings at s and t there
is a shift d < v for which s + d and t + d are both sampled, and the names of the ``length - v + 1``
bytes from there are equal. The steps:

1. name the sampled positions, sort the names, keep those equal to a neighbour;
2. in each document, only those strings can be repeated that hold a position with a kept name;
3. merge what is left: such strings are named by the anchor, the smallest name of ``anchor`` bytes within
   them, which equal strings share. Strings with one anchor form a context. Equal contexts (nearly all of
   the repeats) settle all of their strings at once;
4. one context of each kind that shares its anchor with others names every string, the names are
   sorted, and neighbours compared.

Names are fingerprints of the bytes instead of ranks, so no name needs a round of sorting of its own:
short where a wrong match would only mean more work, 128 bits where it decides. Every step's rows are
positions, never pairs, so groups of copies cost in proportion to their size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import only_ids, small_batches, texts_of, written
from tidegauge.llm.words import OTHER, hash_spans

NO_ID = -(1 << 63)  # stands for a null doc_id
NAME_BITS = 48  # of a sampled position's name
ANCHOR = 256  # share of a string, in 400ths, that an anchor's name covers


def difference_cover(r: int) -> tuple[np.ndarray, int]:
    """(residues, v): a cover of 6r+4 residues modulo 24r^2+36r+13, by its run lengths."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return np.concatenate(([0], np.cumsum(steps))), 24 * r * r + 36 * r + 13


class Sample:
    """Positions sampled for strings of ``length`` bytes, by the largest cover that leaves names of at
    least half of that, or every position if the strings are short."""

    def __init__(self, length: int):
        fitting = [c for r in range(8) if (c := difference_cover(r))[1] <= length // 2]
        self.residues, self.v = fitting[-1] if fitting else (np.zeros(1, np.int64), 1)
        self.length, self.name = length, length - self.v + 1

    def upto(self, end: int) -> np.ndarray:
        """Sampled positions below ``end``."""
        rounds = np.arange(0, max(end, 0), self.v)
        every = (rounds[:, None] + self.residues).ravel()
        return every[every < end]

    def candidates(self, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals [first, last] of starts of strings that hold a position of ``kept``."""
        kept = np.sort(kept)
        apart = np.flatnonzero(np.diff(kept) > self.v)
        first = kept[np.concatenate(([0], apart + 1))] - self.v + 1
        return np.maximum(first, 0), kept[np.append(apart, len(kept) - 1)]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _whole(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = texts_of(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([_whole(t) for t in texts], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            names=["doc_id", "hash", "n_bytes", "sha"],
        )


NAMES = "name long, id long, hash long, at int"


def _names(sample: Sample):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            names, ids, hashes, places = [], [], [], []
            for key, text in zip(batch.column("id").to_pylist(), texts_of(batch.column("text"))):
                if len(text) >= sample.length:
                    at = sample.upto(len(text) - sample.name + 1)
                    names.append(hash_spans(np.frombuffer(text, np.uint8), at, at + sample.name) >> np.uint64(64 - NAME_BITS))
                    places.append(at)
                    ids.append(np.full(len(at), key))
                    hashes.append(np.full(len(at), _whole(text)))
            if names:
                columns = [_signed(np.concatenate(names)), np.concatenate(ids), np.concatenate(hashes)]
                columns.append(np.concatenate(places).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["name", "id", "hash", "at"])

    return scan


def _equal_neighbours(keys: list[str], out: list[str]):
    """Of rows sorted by ``keys``, the columns ``out`` of those equal to the row before or after."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met = None, False  # the last row, and whether it equals the one before
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            values = [table.column(k).to_numpy() for k in keys]
            same = np.logical_and.reduce([v[1:] == v[:-1] for v in values])
            before, after = np.concatenate(([met], same)), np.concatenate((same, [False]))
            keep = before | after
            met, keep[-1] = bool(before[-1]), False
            yield from table.select(out).filter(pa.array(keep)).to_batches()
            held = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0]
        if met:
            yield held.select(out)

    return scan


def _regions(sample: Sample):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, places in enumerate(batch.column("places")):
                first, last = sample.candidates(places.values.to_numpy())
                if len(first):
                    rows.append((i, first.astype(np.int64).tobytes(), last.astype(np.int64).tobytes()))
            if rows:
                which, first, last = zip(*rows)
                part = batch.select(["id", "hash"]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(first, pa.binary()), pa.array(last, pa.binary())],
                    names=["id", "hash", "first", "last"],
                )

    return scan


def _matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text is the one that ``hash`` stands for (an id may have several)."""
    for batch in small_batches(batches, "text"):
        hashes = batch.column("hash").to_pylist()
        yield batch.filter(pa.array([_whole(t) == h for t, h in zip(texts_of(batch.column("text")), hashes)], pa.bool_()))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest (first of equal) value in values[i:i+width], for each i. Compares the upper
    40 bits."""
    n = len(values) - width + 1
    packed = (values >> np.uint64(24) << np.uint64(24)) | np.arange(len(values), dtype=np.uint64)
    full = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(packed)] = packed
    blocks = full.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[width - 1 : width - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


CONTEXTS = "anchor long, context long, check long, id long, hash long, first int, last int"
PIECE = 1 << 22  # starts handled at a time, so that places fit the packed bits


def _contexts(length: int):
    """Candidate strings grouped by the anchor they share: their starts are [first, last]."""
    width = max(length * ANCHOR // 400, 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            rows = []
            for key, whole, text, firsts, lasts in zip(*(batch.column(c).to_pylist() for c in ("id", "hash", "text", "first", "last"))):
                data = np.frombuffer((text or "").encode(), np.uint8)
                bounds = zip(np.frombuffer(firsts, np.int64).tolist(), np.frombuffer(lasts, np.int64).tolist())
                for low, high in bounds:
                    high = min(high, len(data) - length)
                    for begin in range(low, high + 1, PIECE):
                        end = min(begin + PIECE - 1, high)
                        at = np.arange(begin, end + length - width + 1)
                        names = hash_spans(data, at, at + width)
                        place = sliding_argmin(names, length - width + 1)
                        edge = np.flatnonzero(np.diff(place, prepend=-1))
                        first = begin + edge
                        last = np.append(first[1:], end + 1) - 1
                        # where in its context the anchor stands is part of the context's name
                        shift = (begin + place[edge] - first).astype(np.uint64)
                        one = hash_spans(data, first, last + length) ^ shift
                        two = hash_spans(data, first, last + length, OTHER)
                        n = len(first)
                        rows.append((_signed(names[place[edge]]), _signed(one), _signed(two), np.full(n, key),
                                     np.full(n, whole), first.astype(np.int32), last.astype(np.int32)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*rows)],
                    names=["anchor", "context", "check", "id", "hash", "first", "last"],
                )

    return scan


def _strings(length: int):
    """128-bit names of all strings of the listed contexts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 18):
            rows = []
            ids = (batch.column(c).to_pylist() for c in ("id", "hash", "text"))
            for key, whole, text, (first, last) in zip(*ids, _lists(batch.column("spans"), ("first", "last"))):
                data = np.frombuffer((text or "").encode(), np.uint8)
                at = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist())]))
                one, two = hash_spans(data, at, at + length), hash_spans(data, at, at + length, OTHER)
                rows.append((_signed(one), _signed(two), np.full(len(at), key), np.full(len(at), whole), at.astype(np.int32)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*rows)], names=["name", "check", "id", "hash", "at"]
                )

    return scan


def _lists(column: pa.ListArray, fields: tuple[str, str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Two number fields of each row's list of structs."""
    flat = column.flatten()
    one, two = (flat.field(flat.type.get_field_index(f)).to_numpy() for f in fields)
    ends = np.cumsum(pc.list_value_length(column).to_numpy())
    for begin, end in zip([0, *ends[:-1]], ends):
        yield one[begin:end], two[begin:end]


def _removed(n: int, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, int]:
    """(whether each byte goes, maximal runs of those that do) under the union of all [begin, end)."""
    change = np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    gone = np.cumsum(change)[:n] > 0
    return gone, int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = []
        for text, (begin, end) in zip(texts_of(batch.column("text")), _lists(batch.column("spans"), ("a", "b"))):
            gone, runs = _removed(len(text), begin, end)
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        removed, runs, sha, kept = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("hash"),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(sha, pa.string()),
                pa.array(kept, pa.binary()),
            ],
            names=["id", "hash", "n_removed", "n_spans", "kept_sha", "kept"],
        )


def repeated_spans(docs: DataFrame, length: int = 400) -> tuple[DataFrame, DataFrame]:
    """(digests of all rows, what is left of the documents with repeats): see ``remove_repeats``."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = Sample(length)
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text")
    names = texts.select("id", "text").mapInArrow(_names(sample), NAMES).repartition(tasks, "name").sortWithinPartitions("name")
    kept = names.mapInArrow(_equal_neighbours(["name"], ["id", "hash", "at"]), "id long, hash long, at int")
    places = kept.groupBy("id", "hash").agg(F.collect_list("at").alias("places"))
    regions = written(places.mapInArrow(_regions(sample), "id long, hash long, first binary, last binary"), "starts")
    found = only_ids(texts.select("id", "text"), regions, "id").join(regions, "id").mapInArrow(
        _matching, "id long, text string, hash long, first binary, last binary"
    )
    found = written(found, "regions")

    contexts = written(found.mapInArrow(_contexts(length), CONTEXTS), "contexts")
    same = ["anchor", "context", "check"]
    kinds = contexts.groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct("id", "hash", "first", "last")).alias("one"))
    kinds = written(kinds, "kinds")
    settled = contexts.join(kinds.where("n > 1").select(*same), same)
    settled = settled.select("id", "hash", F.col("first").alias("a"), (F.col("last") + length).alias("b"))

    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    ones = kinds.join(mixed, "anchor", "left_semi").select("one.*")
    ones = ones.groupBy("id", "hash").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    strings = found.select("id", "hash", "text").join(ones, ["id", "hash"]).mapInArrow(
        _strings(length), "name long, check long, id long, hash long, at int"
    )
    strings = strings.repartition(tasks, "name").sortWithinPartitions("name", "check")
    equal = strings.mapInArrow(_equal_neighbours(["name", "check"], ["id", "hash", "at"]), "id long, hash long, at int")
    equal = equal.select("id", "hash", F.col("at").alias("a"), (F.col("at") + length).alias("b"))

    spans = settled.union(equal).groupBy("id", "hash").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    left = found.select("id", "hash", "text").dropDuplicates(["id", "hash"]).join(spans, ["id", "hash"])
    left = left.mapInArrow(_cut, "id long, hash long, n_removed long, n_spans long, kept_sha string, kept binary")
    digests = docs.select("doc_id", "text").mapInArrow(_digests, "doc_id long, hash long, n_bytes long, sha string")
    return digests.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))), left


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (what is left, where bytes go).

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of ``length`` bytes that covers it also
    starts anywhere else, in the same text or another; strings are judged on the input and never cross
    documents. Rows that repeat a doc_id are documents of their own, and rows that repeat both doc_id
    and text are copies of each other, so they go whole if they are long enough.
    """
    digests, left = repeated_spans(docs, length)
    return digests.join(left, ["id", "hash"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"),
        "kept",
    )
