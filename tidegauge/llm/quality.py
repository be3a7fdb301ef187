"""Quality classifier: a sparse rule ensemble.

Statistics of a text are computed once, over batches of texts. Boosted trees on a bounded sample of
labelled rows propose rules, conjunctions of thresholds on statistics: the paths to their nodes. A
logistic model with a lasso penalty weighs the rules and drops most. What remains is compiled into one
Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.boosting import boost, sigmoid
from tidegauge.llm.common import small_batches, texts_of
from tidegauge.llm.sampling import class_share, labelled, remainder, sampled
from tidegauge.llm.words import word_hashes

PER_CLASS = 5000  # labelled rows of either class that a model is fitted on, at most

STATS = [
    "log_words", "mean_word", "distinct_words", "upper", "digits", "spaces", "lines_per_word", "stops",
    "bangs", "pipes", "symbols", "high_bytes", "top_byte", "distinct_lines", "max_line", "commas",
]


def _in(chars: bytes) -> np.ndarray:
    return np.array([c in chars for c in range(256)])


_CLASSES = np.stack(
    [
        _in(bytes(range(65, 91))),
        _in(b"0123456789"),
        _in(b" \t\n\x0b\x0c\r"),
        _in(b".?"),
        _in(b"!"),
        _in(b"|"),
        _in(b"#$%&*+/<=>@\\^_`{}~"),
        np.arange(256) >= 128,
        _in(b",;"),
    ],
    axis=1,
).astype(float)


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of STATS per text, shares of bytes or words unless named otherwise; 0 for empty texts."""
    hashes, counts = word_hashes(texts)
    out, at = np.zeros((len(texts), len(STATS))), 0
    for i, (text, words) in enumerate(zip(texts, counts.tolist())):
        if words:
            bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            upper, digits, spaces, stops, bangs, pipes, symbols, high, commas = bytes_ @ _CLASSES / len(text)
            lines = text.split(b"\n")
            out[i] = (
                np.log1p(words), len(text) * (1 - spaces) / words, len(np.unique(hashes[at : at + words])) / words,
                upper, digits, spaces, len(lines) / words, stops, bangs, pipes, symbols, high,
                bytes_[33:].max() / len(text), len(set(lines)) / len(lines), max(map(len, lines)) / len(text), commas,
            )
        at += words
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text, which goes) with a column per statistic."""
    rest = [c for c in docs.columns if c != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            stats = statistics(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), *(pa.array(c) for c in stats.T)], names=[*rest, *STATS]
            )

    kinds = [f"`{n}` {t}" for n, t in docs.dtypes if n != "text"] + [f"{s} double" for s in STATS]
    return docs.mapInArrow(scan, ", ".join(kinds))


@dataclass
class RuleModel:
    bias: float
    rules: list  # (weight, ((feature, whether above, threshold), ...))

    def column(self) -> Column:
        """The score as an expression over STATS."""
        margin = F.lit(self.bias)
        for weight, rule in self.rules:
            holds = F.lit(True)
            for f, above, t in rule:
                holds = holds & ((F.col(STATS[f]) > t) if above else (F.col(STATS[f]) <= t))
            margin = margin + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _holds(x: np.ndarray, rules: list) -> np.ndarray:
    return np.stack(
        [np.logical_and.reduce([(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in r]) for r in rules], axis=1
    ).astype(float)


def fit_rules(x: np.ndarray, y: np.ndarray, prior: float = 0.5, penalty: float = 5e-4, steps: int = 600) -> RuleModel:
    """``prior`` is the share of label 1 that the model is to expect, whatever its share in ``y``.
    Where the trees find no rule, as with one class only, the score is a constant."""
    rules = list(dict.fromkeys(p for t in boost(x, y, trees=20).trees for p in t.paths()))
    if not rules:
        share = (y.sum() + 1) / (len(y) + 1.5)
        return RuleModel(float(np.log(share / (1 - share))) if share < 1 else 1.0, [])
    r = _holds(x, rules)
    weigh = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean())) / len(y)
    a = np.hstack([r, np.ones((len(y), 1))])
    rate = 4 / np.linalg.norm(a * np.sqrt(weigh)[:, None], 2) ** 2
    w = v = np.zeros(a.shape[1])
    momentum = 1.0
    for _ in range(steps):  # accelerated proximal gradient
        new = v - rate * (a.T @ (weigh * (sigmoid(a @ v) - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        nxt = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, w, momentum = new + (momentum - 1) / nxt * (new - w), new, nxt
    return RuleModel(float(w[-1]), [(float(w[i]), rules[i]) for i in np.flatnonzero(w[:-1])])


def train(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> RuleModel:
    """A model of ``labels.quality`` from at most ``per_class`` rows of either class among ``usable``."""
    share = class_share(labels, "quality", usable)
    found = with_statistics(sampled(docs, labelled(labels, "quality", usable, per_class))).toPandas()
    found = found.sort_values(["doc_id", *STATS])
    return fit_rules(found[STATS].to_numpy(float), found["y"].to_numpy(float), share)


def quality_scores(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out (crc32 of the id mod 3 is 1), score, predicted, for every row. Null texts are
    empty; empty texts have the score of all statistics 0. Rows that repeat a doc_id are scored each."""
    rows = with_statistics(docs.select("doc_id", "text"))
    scored = rows.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` without the rows that the model rejects, columns as they were."""
    rows = with_statistics(docs.select(F.struct(*docs.columns).alias("__row"), "text"))
    return rows.where(model.column() >= 0.5).select("__row.*")
