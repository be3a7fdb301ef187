"""Alignment of two tokenizers' ids over a corpus, with an identity map as the fast path.

Both cut the same bytes. Where tokens of both end at the same byte, a group ends; every token of one side in
a group is linked with every one of the other. A pair of ids counts the documents that hold it linked.

Most groups are one token on either side, with the same bytes. An array prepared once gives for each id of
A the id of B with the same bytes; pairs that agree with it are counted in vectors as long as A's vocabulary.
Only other pairs are shuffled: once as partial counts; then those of the ``common`` most frequent, whose
counts fit in a fixed table, are looked up where the documents are, and the rest joined. A pair that
holds a third of all documents is thus never a join key.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import small_batches, texts_of, written

FOLDER = "/opt/tokenizers"
FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
# fixed value: how byte-level vocabularies split text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COMMON = 1 << 17  # pairs whose counts are sent to all tasks: 2 MB
SHIFT = 20  # a pair is a << SHIFT | b; ids have fewer bits
CHUNK = 1 << 20  # links looked at at a time


def _byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 characters for
    themselves, other bytes for U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _named(ids: int) -> dict[str, np.ndarray]:
    """Every id in decimal with each character that may follow it."""
    return {end: np.array([f"{i}{end}" for i in range(ids)], object) for end in ",|;"}


class Tokenizers:
    """Both tokenizers, their ids' bytes, and the identity map.

    A's file lists its merges by id, so merging by smallest id is merging by its rules; the faster library
    does that with the same vocabulary and splitting pattern.
    """

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        byte_of = _byte_of()
        with open(f"{folder}/{FILES[0]}", encoding="utf-8") as file:
            known = json.load(file)
        special = {x["content"] for x in known["added_tokens"]}
        entries = known["model"]["vocab"]
        merged = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in known["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{FILES[0]} does not number its merges in order")
        ranks = {bytes(byte_of[c] for c in s): i for s, i in entries.items() if s not in special}
        # special tokens' strings in a text are then ordinary text
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{FILES[1]}")
        bytes_a = [b""] * (max(entries.values()) + 1)
        for whole, i in ranks.items():
            bytes_a[i] = whole
        bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        # of ids of B with the same bytes, ordinary pieces before single bytes and control pieces
        first: dict[bytes, int] = {}
        for odd in (False, True):
            for i, whole in enumerate(bytes_b):
                if odd == (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)):
                    first.setdefault(whole, i)
        self.same = np.array([first.get(x, -1) for x in bytes_a])
        self.size_a, self.size_b = (np.array([len(x) for x in v]) for v in (bytes_a, bytes_b))
        self.bytes_a, self.bytes_b = np.array(bytes_a, object), np.array(bytes_b, object)
        self.name_a, self.name_b = _named(len(bytes_a)), _named(len(bytes_b))


@lru_cache(maxsize=2)
def tokenizers_in(folder: str) -> Tokenizers:
    """Loaded once per worker."""
    return Tokenizers(folder)


def _links(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, how often each is linked) over groups of ``n_a`` and ``n_b`` consecutive ids of ``a`` and ``b``."""
    from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    size = n_a * n_b
    pairs, times = [], []
    for g in np.flatnonzero(size > CHUNK).tolist():
        # one long group: its distinct ids, and some of A's at a time
        (x, nx), (y, ny) = (
            np.unique(v[f : f + n], return_counts=True) for v, f, n in ((a, from_a[g], n_a[g]), (b, from_b[g], n_b[g]))
        )
        step = max(1, CHUNK // len(y))
        for i in range(0, len(x), step):
            pairs.append((x[i : i + step, None] << SHIFT | y).ravel())
            times.append((nx[i : i + step, None] * ny).ravel())
    few = np.flatnonzero(size <= CHUNK)
    cuts = np.flatnonzero(np.diff(np.cumsum(size[few]) // CHUNK, prepend=0))
    for part in np.split(few, cuts):
        if len(part):
            s = size[part]
            g = np.repeat(part, s)
            at = np.arange(len(g)) - np.repeat(np.cumsum(s) - s, s)
            p, n = np.unique(a[from_a[g] + at // n_b[g]] << SHIFT | b[from_b[g] + at % n_b[g]], return_counts=True)
            pairs.append(p)
            times.append(n)
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(pairs) == 1 and len(few):
        return pairs[0], times[0]
    found, where = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, np.concatenate(times))
    return found, total


NOTHING = np.empty(0, np.int64)


def align(text: bytes, a: list[int], b: list[int], known: Tokenizers) -> tuple | None:
    """(n_a, n_b, groups, n_links, digest, ids of A linked with their namesake, how often, other pairs, how
    often) of a text and its two encodings; None where it has no tokens."""
    whole, ids_a, ids_b = b" " + text, np.array(a, np.int64), np.array(b, np.int64)
    if not text or any(b"".join(v[ids].tolist()) != whole for v, ids in ((known.bytes_a, ids_a), (known.bytes_b, ids_b))):
        return None
    ends_a, ends_b = np.cumsum(known.size_a[ids_a]), np.cumsum(known.size_b[ids_b])
    in_a, in_b = np.zeros((2, len(whole) + 1), bool)
    in_a[ends_a], in_b[ends_b] = True, True
    last_a, last_b = np.flatnonzero(in_b[ends_a]), np.flatnonzero(in_a[ends_b])  # of each group
    n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)

    # all ids in the order of the groups, each with the character after it
    said = np.empty(len(a) + len(b), object)
    names_a, names_b = known.name_a[","][ids_a], known.name_b[","][ids_b]
    names_a[last_a], names_b[last_b] = known.name_a["|"][ids_a[last_a]], known.name_b[";"][ids_b[last_b]]
    said[np.arange(len(a)) + np.repeat(last_b - n_b + 1, n_a)] = names_a
    said[np.arange(len(b)) + np.repeat(last_a + 1, n_b)] = names_b
    digest = hashlib.sha256("".join(said.tolist())[:-1].encode()).hexdigest()

    single = (n_a == 1) & (n_b == 1)
    x, y = ids_a[last_a[single]], ids_b[last_b[single]]
    named = known.same[x] == y
    own, often = np.unique(x[named], return_counts=True)
    odd = np.ones(len(n_a), bool)
    odd[np.flatnonzero(single)[named]] = False
    pairs, times = _links(ids_a[np.repeat(odd, n_a)], ids_b[np.repeat(odd, n_b)], n_a[odd], n_b[odd])
    # namesakes may meet in a larger group too
    home = known.same[pairs >> SHIFT] == pairs & ((1 << SHIFT) - 1)
    if home.any():
        own, where = np.unique(np.concatenate([own, pairs[home] >> SHIFT]), return_inverse=True)
        often = np.bincount(where, np.concatenate([often, times[home]])).astype(np.int64)
        pairs, times = pairs[~home], times[~home]
    return len(a), len(b), len(n_a), int((n_a * n_b).sum()), digest, own, often, pairs, times


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values or [NOTHING])).cast(kind))


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "own array<int>, own_times array<int>, pairs array<long>, times array<int>"
)


def _aligned(folder: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers_in(folder)
        for batch in small_batches(batches, "text", 1 << 19):
            raw = texts_of(batch.column("text"))
            texts = [t.decode() for t in raw]
            in_a = [known.a.encode_ordinary(" " + t) for t in texts]
            in_b = known.b.encode(texts, num_threads=1)
            nothing = (0, 0, 0, 0, "", NOTHING, NOTHING, NOTHING, NOTHING)
            rows = [align(t, a, b, known) or nothing for t, a, b in zip(raw, in_a, in_b)]
            columns = list(zip(*rows))
            longs = [pa.array(c, pa.int64()) for c in columns[:4]]
            lists = [_lists(list(c), kind) for c, kind in zip(columns[5:], (pa.int32(), pa.int32(), pa.int64(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *longs, pa.array(columns[4], pa.string()), *lists],
                names=[c.split()[0] for c in ALIGNED.split(", ")],
            )

    return scan


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Each row of ``docs`` (doc_id, text): its tokens, groups and links, distinct ids of A linked with their
    namesake in B (own) and other linked pairs (pairs), both with how often. Written once; the tokenizers
    run once over each text. ``row`` tells rows of equal doc_id apart."""
    rows = docs.select("doc_id", "text").mapInArrow(_aligned(folder), ALIGNED)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")


def _own_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many rows hold each id of A linked with its namesake; a vector of the vocabulary's length."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("own").flatten().to_numpy(), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids])], ["a", "n"])

    out = np.zeros(size, np.int64)
    for a, n in rows.select("own").mapInArrow(counted, "a int, n long").groupBy("a").agg(F.sum("n")).collect():
        out[a] = n
    return out


def alignment(docs: DataFrame, folder: str = FOLDER, common: int = COMMON) -> DataFrame:
    """Each row's alignment: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its A id's highest
    count, ties included), count_sum (of the links' pairs' counts), groups_sha256.

    A pair's count is the number of rows of ``docs`` that hold it linked; rows that repeat a doc_id count one by
    one. Null and empty texts, and those that either tokenizer does not give back byte for byte, have no
    tokens: zeros, and an empty groups_sha256. Other columns are ignored; an empty table gives no rows.
    ``folder`` holds the tokenizer files on every executor.
    """
    spark = docs.sparkSession
    rows = aligned(docs, folder)
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts, "pair_counts")
    size = len(tokenizers_in(folder).bytes_a)
    own = _own_counts(rows, size)
    best = own.copy()
    top = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("n"))
    for a, n in top.collect():  # one row per id of A at most
        best[a] = max(best[a], n)
    heads = counts.orderBy(F.desc("n"), "pair").limit(common).collect()
    heads = np.array([tuple(r) for r in heads], np.int64).reshape(-1, 2)
    heads = heads[np.argsort(heads[:, 0])]
    shared = spark.sparkContext.broadcast((own, best, heads))  # three bounded tables

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over namesakes and common pairs; the pairs left to look up."""
        own, best, heads = shared.value
        hit = own == best
        for batch in batches:
            n_best, total, left, left_times = [], [], [], []
            columns = [batch.column(c) for c in ("own", "own_times", "pairs", "times")]
            cut = [(c.offsets.to_numpy(), c.values.to_numpy().astype(np.int64)) for c in columns]
            for i in range(batch.num_rows):
                ids, times, pairs, often = (values[at[i] : at[i + 1]] for at, values in cut)
                where = np.minimum(np.searchsorted(heads[:, 0], pairs), max(len(heads) - 1, 0))
                found = heads[where, 0] == pairs if len(heads) else np.zeros(len(pairs), bool)
                n = heads[where[found], 1] if len(heads) else NOTHING
                n_best.append(int(times[hit[ids]].sum() + often[found][n == best[pairs[found] >> SHIFT]].sum()))
                total.append(int((times * own[ids]).sum() + (often[found] * n).sum()))
                left.append(pairs[~found])
                left_times.append(often[~found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                 _lists(left, pa.int64()), _lists(left_times, pa.int32())],
                names=["row", "n_best", "count_sum", "pairs", "times"],
            )

    kinds = "row long, n_best long, count_sum long, pairs array<long>, times array<int>"
    parts = written(rows.select("row", "own", "own_times", "pairs", "times").mapInArrow(near, kinds), "near_sums")
    rare = parts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    highest = spark.createDataFrame([(int(a), int(n)) for a, n in enumerate(best) if n], "a long, best long")
    met = rare.join(counts, F.col("pairs") == F.col("pair")).join(
        F.broadcast(highest), F.shiftright("pairs", SHIFT) == F.col("a")
    )
    far = met.select(
        "row",
        F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    sums = parts.select("row", "n_best", "count_sum").unionByName(far).groupBy("row")
    sums = sums.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
