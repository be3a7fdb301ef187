"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in its (hashed) words; a document is
toxic if any of its sentences is: their scores are combined by noisy-or, 1 - prod(1 - p). Only
documents carry labels; the gradient of the noisy-or hands the blame to sentences. The trained sentence
scores then also locate what is offending.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.boosting import sigmoid
from tidegauge.llm.common import small_batches, texts_of
from tidegauge.llm.decontam import _WORD
from tidegauge.llm.sampling import class_share, labelled, remainder, sampled
from tidegauge.llm.words import hash_spans

BITS = 18  # hashed words: the model has 2^BITS weights, whatever the corpus
STEMS = (4, 5, 6)  # bytes of a word's beginnings that are features too, for inflected words
PER_CLASS = 4000  # labelled rows of either class that a model is fitted on, at most
LEAST = 3  # toxic documents that a feature must be seen in
_STOP = np.array([c in b".!?\n" for c in range(256)])


def sentences(texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Pairs of arrays (feature, sentence), for words and their beginnings; text and end (byte after the
    last, texts joined by line feeds) of every sentence. Words are as in ``decontam``; a sentence ends
    with . ! ? or a line feed, and one without words does not count."""
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw.translate(_WORD), np.uint8)
    edges = np.flatnonzero(np.diff((data == 32).astype(np.int8), prepend=1))
    start, end = edges[::2], edges[1::2]
    stops = np.flatnonzero(_STOP[np.frombuffer(raw, np.uint8)])
    used, sentence = np.unique(np.searchsorted(stops, start), return_inverse=True)
    features = [(_feature(data, start, end), sentence)]
    for n in STEMS:
        longer = end - start > n
        features.append((_feature(data, start[longer], start[longer] + n), sentence[longer]))
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), stops[used] + 1, "left")
    return features, text, stops[used] + 1


def _feature(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (hash_spans(data, start, end) >> np.uint64(64 - BITS)).astype(np.int64)


class Model:
    def __init__(self, bias: float, weights: np.ndarray):
        self.bias, self.weights = bias, weights

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(score of each text), and of each sentence its score, text and end."""
        features, text, end = sentences(texts)
        margin = sum(np.bincount(s, self.weights[f], len(text)) for f, s in features)
        p = sigmoid(self.bias + margin)
        return -np.expm1(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), len(texts))), p, text, end


def _screened(pieces: list[list[bytes]], y: np.ndarray) -> np.ndarray:
    """Features seen in LEAST toxic documents and in a larger share of these than of the others."""
    seen, at = np.zeros((2, 1 << BITS)), 0
    for piece in pieces:
        features, text, _ = sentences(piece)
        docs = np.unique(np.concatenate([f << 32 | (text[s] + at) for f, s in features]))
        for label in (0, 1):
            seen[label] += np.bincount(docs[y[docs & 0xFFFFFFFF] == label] >> 32, minlength=1 << BITS)
        at += len(piece)
    share = (seen + 0.5) / (np.array([[(y == 0).sum()], [(y == 1).sum()]]) + 1)
    return (seen[1] >= LEAST) & (share[1] > 2 * share[0])


def fit(texts: list[bytes], y: np.ndarray, prior: float = 0.5, steps: int = 200, rate: float = 0.1, decay: float = 1e-4):
    """Noisy-or logistic model by full gradients with adaptive steps; ``prior`` is the share of toxic
    documents it is to expect. Features that are not commoner in toxic documents weigh nothing. With one
    class only, all scores are low."""
    pieces = [texts[i : i + 200] for i in range(0, len(texts), 200)]
    known = _screened(pieces, y) if pieces else np.zeros(1 << BITS, bool)
    column = np.cumsum(known) - 1
    feature, sentence, text, n, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, 0
    for piece in pieces:
        features, texts_, _ = sentences(piece)
        for f, s in features:
            feature.append(column[f[known[f]]])
            sentence.append(s[known[f]] + n)
        text.append(texts_ + at)
        n, at = n + len(texts_), at + len(piece)
    feature, sentence, text = map(np.concatenate, (feature, sentence, text))
    share = np.array([1 - prior, prior]) / np.maximum(np.bincount(y.astype(int), minlength=2), 1)
    weigh = share[y.astype(int)]
    w = np.zeros(int(known.sum()) + 1)  # the last is the bias
    w[-1] = -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = sigmoid(w[-1] + np.bincount(sentence, w[feature], n))
        clean = np.exp(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))
        slope = (np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weigh)[text] * p
        grad = np.append(np.bincount(feature, slope[sentence], len(w) - 1) + decay * w[:-1], slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[known] = w[:-1]
    return Model(float(w[-1]), weights)


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Model:
    """A model of ``labels.toxic`` from at most ``per_class`` rows of either class among ``usable``."""
    share = class_share(labels, "toxic", usable)
    rows = sorted(sampled(docs, labelled(labels, "toxic", usable, per_class)).collect(), key=lambda r: (r[0], r[1] or ""))
    return fit([(r["text"] or "").encode() for r in rows], np.array([r["y"] for r in rows], float), share)


def toxicity_scores(docs: DataFrame, model: Model, offending: float = 0.5) -> DataFrame:
    """doc_id, held_out (crc32 of the id mod 5 is 0), score, predicted, and offending: the places of
    sentences that score ``offending`` or more, as start:end in UTF-8 bytes. Null texts are empty; texts
    without words score 0. Rows that repeat a doc_id are scored each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = texts_of(batch.column("text"))
            score, p, text, end = shared.value.scores(texts)
            begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            places: list[list[str]] = [[] for _ in texts]
            start = np.concatenate(([0], end[:-1])) if len(end) else end
            for i in np.flatnonzero(p >= offending):
                low = begins[text[i]]
                places[text[i]].append(f"{max(start[i], low) - low}:{min(end[i] - low, len(texts[text[i]]))}")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array([",".join(x) for x in places], pa.string())],
                names=["doc_id", "score", "offending"],
            )

    rows = docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, score double, offending string")
    return rows.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending",
    )
