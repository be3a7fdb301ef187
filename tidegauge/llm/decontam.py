"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every substring (of words) of every item. A document's words stream through it,
and the length of the longest suffix that still matches is tracked; where it reaches ``window`` words,
or an item shorter than that ends, the words are hit. Each item window knows its items by the state in
which it is met.

An automaton holds at most ``max_words`` item words, which bounds what executors load. A larger set of
items is cut into blocks of that size, through which the documents pass one after the other, gathering
hits. Before the automaton, numpy drops the stretches that cannot match: consecutive words that never
follow each other in any item.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import small_batches, texts_of, written

WINDOW = 10
# word bytes stay (A-Z as a-z), all others become blanks
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


class Automaton:
    """Generalised suffix automaton over word numbers (from 1; 0 is any other word)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        numbered = [(item, [self.words.setdefault(w, len(self.words) + 1) for w in words]) for item, words in items if words]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in numbered:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.items: dict[int, set] = {}  # items by the state of a window
        self.short: dict[int, list] = {}  # (words, item) of whole items under a window
        for item, words in numbered:
            state = held = 0
            for w in words:
                state, held = self.step(state, held, w)
                if held == window:
                    self.items.setdefault(state, set()).add(item)
            if len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
        self.least = min([window, *(len(w) for _, w in numbered)])
        self.pairs = np.unique(
            np.concatenate([np.zeros(0, np.int64), *(self._pairs(np.array(w, np.int64)) for _, w in numbered)])
        )

    def _pairs(self, words: np.ndarray) -> np.ndarray:
        return words[:-1] * (len(self.words) + 1) + words[1:]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state for the words of p followed by w: q, or a copy of q for its shorter substrings."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w)
        state, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, self.next[p][w], w)
        return state

    def step(self, state: int, held: int, w: int) -> tuple[int, int]:
        """State and length of the longest match, up to a window, after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            held = self.length[state]
        if w not in self.next[state]:
            return 0, 0
        state, held = self.next[state][w], min(held + 1, self.window)
        while self.length[self.link[state]] >= held:
            state = self.link[state]
        return state, held

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where a match may be: [begin, end) of words that follow each other in some item."""
        known = ids > 0
        if self.least == 1:
            ok = known[:-1] & known[1:]
        else:
            ok = np.zeros(max(len(ids) - 1, 0), bool)
            both = np.flatnonzero(known[:-1] & known[1:])
            codes = ids[both] * (len(self.words) + 1) + ids[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, codes), max(len(self.pairs) - 1, 0))
            ok[both] = self.pairs[at] == codes if len(self.pairs) else False
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ok, [False])).astype(np.int8)))
        begin, end = edges[::2], edges[1::2] + 1
        if self.least == 1:
            alone = known & ~np.concatenate(([False], ok)) & ~np.concatenate((ok, [False]))
            single = np.flatnonzero(alone)
            begin, end = np.concatenate((begin, single)), np.concatenate((end, single + 1))
        fit = end - begin >= self.least
        return list(zip(begin[fit].tolist(), end[fit].tolist()))

    def scan(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, str]]]:
        """(words hit, (place, item) of windows met) of a sequence of word numbers."""
        hit, met = np.zeros(len(ids), bool), []
        for begin, end in self.stretches(ids):
            state = held = 0
            for at, w in enumerate(ids[begin:end].tolist(), begin):
                state, held = self.step(state, held, w)
                if held == self.window:
                    hit[at - held + 1 : at + 1] = True
                    met += [(at, item) for item in self.items[state]]
                if self.short:
                    up = state
                    while up > 0:
                        for n, item in self.short.get(up, ()):
                            if n <= held:
                                hit[at - n + 1 : at + 1] = True
                                met.append((at, item))
                        up = self.link[up]
        return hit, met


def automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = 500_000) -> Iterator[Automaton]:
    """One automaton per block of items (item_id, text) of at most ``max_words`` words, or one item.
    Items stream to the driver; it holds a block at a time."""
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = words_of((text or "").encode())
        if block and size + len(words) > max_words:
            yield Automaton(block, window)
            block, size = [], 0
        block.append((item, words))
        size += len(words)
    yield Automaton(block, window)


def _ids(texts: list[bytes], words: dict[bytes, int]) -> tuple[np.ndarray, list[int]]:
    """Word numbers of all texts, a 0 after each, and the texts' numbers of words."""
    split = [words_of(t) for t in texts]
    counts = [len(s) for s in split]
    get, end = words.get, [b""]
    every = itertools.chain.from_iterable(itertools.chain.from_iterable((s, end) for s in split))
    return np.fromiter((get(w, 0) for w in every), np.int64, sum(counts) + len(counts)), counts


def _scanned(automaton, first: bool):
    """Adds this automaton's hits: packed bits of the words hit, and the item ids met."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Automaton = automaton.value
        for batch in small_batches(batches, "text"):
            ids, counts = _ids(texts_of(batch.column("text")), model.words)
            hit, met = model.scan(ids)
            begins = np.concatenate(([0], np.cumsum(np.array(counts, np.int64) + 1)))
            found: dict[int, set] = {}
            for at, item in met:
                found.setdefault(int(np.searchsorted(begins, at, "right")) - 1, set()).add(item)
            bits = [b""] * len(counts)
            for i in np.flatnonzero(np.add.reduceat(hit, begins[:-1]) if len(counts) else []).tolist():
                bits[i] = np.packbits(hit[begins[i] : begins[i + 1] - 1]).tobytes()
            items = [sorted(x for x in found.get(i, ()) if x is not None) for i in range(len(counts))]
            if not first:
                for i, (old, known) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())):
                    items[i] = sorted({*items[i], *known})
                    if old and bits[i]:
                        bits[i] = np.bitwise_or(np.frombuffer(old, np.uint8), np.frombuffer(bits[i], np.uint8)).tobytes()
                    bits[i] = bits[i] or old
            kept = [c for c in batch.schema.names if c not in ("hits", "items", "n_words")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(counts, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*kept, "n_words", "hits", "items"],
            )

    return scan


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _through(docs: DataFrame, benchmark: DataFrame, window: int, max_words: int, finish: Step, kind) -> DataFrame:
    """``docs`` after all automata, with n_words, hits and items handed to ``finish`` (whose rows are of
    ``kind``) in the Python worker that runs the last one."""
    spark, source, scan = docs.sparkSession, docs, None
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", n_words long, hits binary, items array<string>"
    for model in automata(benchmark, window, max_words):
        if scan is not None:
            source = written(source.mapInArrow(scan, kinds), "hits")  # one automaton at a time in an executor
        scan = _scanned(spark.sparkContext.broadcast(model), scan is None)
    return source.mapInArrow(lambda batches: finish(scan(batches)), kind)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_words: int = 500_000) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A window is ``window`` consecutive words of an item, or a whole item of fewer; a document word inside
    any occurrence of one is hit. Null and empty texts have no words; items without words match nothing.
    Items with a null item_id hit words, but are not listed; rows that repeat an item_id are one item.
    Columns of ``docs`` other than doc_id and text are ignored.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [int(np.unpackbits(np.frombuffer(b, np.uint8)).sum()) for b in batch.column("hits").to_pylist()]
            items = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    pa.array(hits, pa.int64()),
                    pa.array([len(i) for i in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                    pa.array([h > 0 for h in hits], pa.bool_()),
                    batch.column("items"),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
            )

    kind = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"
    return _through(docs.select("doc_id", "text"), benchmark, window, max_words, digests, kind)


def _without(text: bytes, hits: np.ndarray) -> bytes:
    """``text`` without the runs of hit words (and what stands between them)."""
    spans = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD))]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hits, [False])).astype(np.int8)))
    out, at = [], 0
    for begin, end in zip(edges[::2], edges[1::2]):
        out.append(text[at : spans[begin][0]])
        at = spans[end - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, window: int = WINDOW, max_words: int = 500_000
) -> DataFrame:
    """``docs`` without benchmark text. A document goes if more than ``max_coverage`` of its words are
    hit; from the others, the runs of hit words are cut out, so n_chars (where there is such a column)
    is the new length. Documents without hits stay as they are."""
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), []
            for i, (n, packed) in enumerate(zip(batch.column("n_words").to_pylist(), batch.column("hits").to_pylist())):
                hits = np.unpackbits(np.frombuffer(packed, np.uint8))[:n].astype(bool)
                keep.append(hits.sum() <= max_coverage * n)
                if keep[-1] and hits.any():
                    texts[i] = _without(texts[i].encode(), hits).decode()
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    out = _through(docs, benchmark, window, max_words, cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
