"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Spans of the four base kinds (email, ip, card, phone) are found by their formats and always reported.
Beyond these, high-recall generators propose overlapping spans: obfuscated addresses, runs of digits,
mixed tokens, values after a credential's name. Boosted trees score a proposal by its format and its
context. They learn from a bounded sample of proposals, dealt evenly over generators, classes and what
touches a base span or does not. In it base spans, credentials of known formats and numbers after a word
such as "phone" stand for personal data, malformed look-alikes and other tokens for the rest. Histograms
of the scores of all labelled proposals that touch no base span then give each generator the lowest
threshold above which they reach ``PRECISION``, or else the lowest above which none of them is left.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.boosting import Boosted, boost, sigmoid
from tidegauge.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
ADDED = ("contact", "number", "token", "secret")  # kinds of the generators
SAMPLE = 20_000  # proposals that a model is fitted on, at most
PRECISION = 0.98
BINS, STEP = 500, 0.02  # of a histogram of log odds, from 0 (a score of 0.5)
DRAWS = 1 << 56  # draws are smaller

# fixed values: formats of the base kinds
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# formats of the generators
_CONTACT = re.compile(
    r"[A-Za-z0-9._%+-]+\s?[\[({]\s?(?:at|@)\s?[\])}]\s?[A-Za-z0-9-]+"
    r"(?:\s?(?:\.|[\[({]\s?(?:dot|\.)\s?[\])}])\s?[A-Za-z0-9-]+)+"
)
_NUMBER = re.compile(r"\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,18}")
_TOKEN = re.compile(r"[A-Za-z0-9_+/=-]{12,}")
_SECRET = re.compile(r"([A-Za-z_-]{2,20})\s?[=:]\s?[\"']?([^\s\"']{6,})")
# credentials whose format is public: key ids, service tokens, and what follows such names
_KNOWN = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}")
_NAMES = ("password", "passwd", "pwd", "token", "secret", "key", "api", "auth")
# words before a number that tell of a person, or of something else
_CUES = re.compile(
    r"\b(?:(calls?|phone|telephone|tel|mobile|cell|fax|mail|contact|card|account|acct|iban|ssn|social security|passport|"
    r"ip|user|login|id)|(order|invoice|ref|reference|isbn|issn|doi|version|pages?|chapter|section|article|item|sku|"
    r"serial|build|year|date|total|price|sum|usd|eur))\b"
)
_DATE = re.compile(r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}\b.*|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}", re.S)
_PERSONAL = re.compile(r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}")  # local phones, ssn


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", max(at + 1, done))


def _small(digits: str) -> bool:
    """At most 255, however long."""
    return len(digits.lstrip("0")) <= 3 and int(digits[-3:]) <= 255


def _numbers_with_dots(text: str) -> Iterator[tuple[int, int]]:
    """All of the ip format, good or not. A match can only begin where a run of digits begins."""
    run = _DIGITS.search(text)
    while run:
        found = _IP.match(text, run.start())
        if found:
            yield found.span()
        run = _DIGITS.search(text, found.end() if found else run.end())


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """(start, end) in code points of the base kinds, leftmost and not overlapping within a kind; what
    has the format but fails its check is dropped without another try."""
    out = {k: [] for k in KINDS}
    out["email"] = list(_emails(text))
    if _DIGITS.search(text):
        out["ip"] = [(a, b) for a, b in _numbers_with_dots(text) if all(_small(p) for p in text[a:b].split("."))]
        for m in _CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(generator, start, end) of all generators; spans may overlap."""
    out = []
    if any(c in text for c in "[({"):
        out += [(0, *m.span()) for m in _CONTACT.finditer(text)]
    if _DIGITS.search(text):
        out += [(1, *m.span()) for m in _NUMBER.finditer(text)]
        out += [(2, *m.span()) for m in _TOKEN.finditer(text) if _DIGITS.search(m[0])]
    if "=" in text or ":" in text:
        out += [(3, *m.span(2)) for m in _SECRET.finditer(text)]
    return out


def cue(before: str) -> tuple[int, str]:
    """What the last telling word of a number's (lower-case) context says: 1 a person's, -1 not, 0 nothing."""
    last = None
    for last in _CUES.finditer(before):
        pass
    return (1 if last[1] else -1, last[0]) if last else (0, "")


def features(text: str, generator: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, n = text[start:end], end - start
    digits = sum(c.isdigit() for c in span)
    upper = sum(c.isupper() for c in span)
    lower = sum(c.islower() for c in span)
    counts = {c: span.count(c) for c in set(span)}
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    before = text[max(0, start - 24) : start].lower()
    return [
        generator, n, digits, digits / n, upper / n, lower / n, n - digits - upper - lower, entropy, changes,
        max((len(p) for p in re.split("[^0-9]+", span)), default=0), span.count("."), span.count("-"), span.count(" "),
        float(span[0] == "+"), float("(" in span), float("@" in span or "(at)" in span),
        float(any(w in before for w in _NAMES)), cue(before)[0],
        float(before[-1:] in "=:\"'" and before != ""), float(text[end : end + 1].isalnum()),
        float(text[start - 1 : start].isalnum()) if start else 0.0, sum(c in "aeiou" for c in span.lower()) / n,
    ]


def teacher(text: str, base: list[tuple[int, int]], generator: int, start: int, end: int) -> int | None:
    """1 for a span known to be personal or a credential, 0 for one known not to be, None if neither."""
    span = text[start:end]
    if any(a < end and start < b for a, b in base):
        return 1 if any(a <= start + 1 and end - 1 <= b for a, b in base) else None
    if _KNOWN.fullmatch(span):
        return 1
    if generator == 0:
        return 1
    if generator == 1:
        return _number(text, start, end)
    if generator == 3 or text[:start].rstrip("\"' =:")[-12:].lower().endswith(_NAMES):
        name = text[max(0, start - 26) : start].rstrip("\"' =:").lower()
        return int(name.endswith(_NAMES))
    return 0


def _number(text: str, start: int, end: int) -> int | None:
    """Label of a number that touches no base span, by its context."""
    span = text[start:end]
    if text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum() or _DATE.fullmatch(span):
        return 0  # cut out of a token, or a date
    digits = re.sub("[^0-9]", "", span)
    said, word = cue(text[max(0, start - 24) : start].lower())
    if said > 0:
        return int(word != "card" or luhn(digits))
    if text[:start].rstrip("\"' =:")[-12:].lower().endswith(_NAMES):
        return 1
    return None if said == 0 and _PERSONAL.fullmatch(span) else 0


@dataclass
class Model:
    trees: Boosted
    thresholds: list  # by generator; above 1 adds nothing


def threshold(hits: np.ndarray, misses: np.ndarray) -> float:
    """The lowest score of at least 0.5 above which ``PRECISION`` of the proposals, counted by bin, are hits;
    if there is none, the lowest above which there are no proposals."""
    above, wrong = np.cumsum(hits[::-1])[::-1], np.cumsum(misses[::-1])[::-1]
    good = np.flatnonzero((above + wrong == 0) | (above >= PRECISION * (above + wrong)))
    return float(sigmoid(np.array(good[0] * STEP))) if len(good) else 2.0


# generator, class, and whether a proposal touches no base span
Kind = tuple[int, int, bool]
KIND = {"generator": pa.int32(), "y": pa.int32(), "novel": pa.bool_()}
KIND_SCHEMA = "generator int, y int, novel boolean"


def _labelled(batch: pa.RecordBatch) -> Iterator[tuple[Kind, int, tuple[str, int, int, int]]]:
    """(kind, draw, proposal) of the labelled proposals of a batch."""
    for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        found = proposals(text or "")
        base = [s for spans in base_spans(text).values() for s in spans] if found else []
        for g, a, b in found:
            y = teacher(text, base, g, a, b)
            if y is not None:
                draw = hashlib.blake2b(f"{key}:{g}:{a}:{text[a:b]}".encode(), digest_size=7).digest()
                novel = not any(p < b and a < q for p, q in base)
                yield (g, y, novel), int.from_bytes(draw, "big"), (text, g, a, b)


def _table(rows: list[tuple], **kinds: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of labelled proposals by kind: generator, class and whether they touch no base span."""
    seen: Counter = Counter()
    for batch in small_batches(batches, "text"):
        seen.update(kind for kind, *_ in _labelled(batch))
    yield from _table([(*kind, n) for kind, n in seen.items()], **KIND, n=pa.int64())


def _examples(below: dict[Kind, int]):
    """Proposals whose draw is ``below`` that of their kind."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = [(*kind, draw, features(*p)) for kind, draw, p in _labelled(batch) if draw < below[kind]]
            yield from _table(rows, **KIND, draw=pa.int64(), features=pa.list_(pa.float64()))

    return scan


def _histogram(trees: Boosted):
    """Numbers of labelled proposals that touch no base span, by generator, class and bin of the score."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in small_batches(batches, "text"):
            rows = [(kind, p) for kind, _, p in _labelled(batch) if kind[2]]
            if rows:
                margin = trees.margin(np.array([features(*p) for _, p in rows]))
                bins = np.minimum(np.floor(margin / STEP), BINS - 1).astype(int).tolist()
                seen.update((g, y, k) for ((g, y, _), _), k in zip(rows, bins) if k >= 0)
        yield from _table([(*k, n) for k, n in seen.items()], generator=pa.int32(), y=pa.int32(), bin=pa.int32(), n=pa.int64())

    return scan


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trees from at most ``sample`` proposals, as many of each kind, those with the smallest draws; thresholds
    from all proposals. Without labelled proposals nothing is added."""
    texts = docs.select("doc_id", "text")
    counts = texts.mapInArrow(_counts, f"{KIND_SCHEMA}, n long").groupBy(*KIND).agg(F.sum("n").alias("n"))
    most = max(sample // (3 * len(ADDED)), 1)  # what touches a base span has one class only
    near = most + 6 * math.isqrt(most) + 10  # so many have smaller draws than the bound, about
    below = {tuple(r[k] for k in KIND): DRAWS * min(near, r["n"]) // r["n"] for r in counts.collect()}
    if not below:
        return Model(boost(np.zeros((0, 1)), np.zeros(0)), [2.0] * len(ADDED))
    drawn = texts.mapInArrow(_examples(below), f"{KIND_SCHEMA}, draw long, features array<double>").collect()
    by: dict[Kind, list] = {}
    for r in sorted(drawn, key=lambda r: (r["draw"], r["features"])):
        by.setdefault(tuple(r[k] for k in KIND), []).append(r["features"])
    rows = [(f, k[1]) for k in sorted(by) for f in by[k][:most]]
    trees = boost(np.array([f for f, _ in rows], float), np.array([y for _, y in rows], float), trees=25)
    binned = texts.mapInArrow(_histogram(trees), "generator int, y int, bin int, n long").groupBy("generator", "y", "bin")
    seen = np.zeros((len(ADDED), 2, BINS), np.int64)
    for r in binned.agg(F.sum("n").alias("n")).collect():
        seen[r["generator"], r["y"], r["bin"]] = r["n"]
    return Model(trees, [threshold(hits, misses) for misses, hits in seen])


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], model: Model) -> list[tuple[int, int, int]]:
    """(generator, start, end) of selected proposals: best first, none overlapping a base span or another."""
    found = [p for p in proposals(text) if model.thresholds[p[0]] <= 1]
    taken = sorted(s for spans in base.values() for s in spans)
    found = [p for p in found if not any(a < p[2] and p[1] < b for a, b in taken)]
    if not found:
        return []
    score = model.trees.score(np.array([features(text, *p) for p in found]))
    out: list[tuple[int, int, int]] = []
    for i in np.lexsort(([p[1] for p in found], [p[1] - p[2] for p in found], -score)).tolist():
        g, a, b = found[i]
        if score[i] >= model.thresholds[g] and not any(x < b and a < y for _, x, y in out):
            out.append(found[i])
    return sorted(out)


def find_personal(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, numbers of base spans by kind, base_sha256 and spans as kind:start:end (base ones
    in the order of KINDS, then added ones in that of ADDED; code points, end exclusive). Null and empty
    texts have none; rows that repeat a doc_id are reported each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few dozen small trees

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            counts, shas, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                said = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
                more = [f"{ADDED[g]}:{a}:{b}" for g, a, b in added_spans(text or "", base, shared.value)]
                counts.append([len(base[k]) for k in KINDS])
                shas.append(hashlib.sha256(said.encode()).hexdigest())
                spans.append(",".join([said, *more]) if said else ",".join(more))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))),
                    pa.array(shas, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )


def redact(text: str, spans: str, mask: str = "[{}]") -> str:
    """``text`` with its reported spans replaced by their kinds; overlapping ones by the first."""
    out, at = [], 0
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)):
        if b > at:
            out += [text[at:a], mask.format(kind)] if a >= at else []
            at = b
    return "".join([*out, text[at:]])
