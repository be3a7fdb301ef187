"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BLOCK = 1 << 19  # bytes hashed at a time

# A-Z to a-z
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# true for the white space 09-0D and 20
SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
OTHER = mix(np.arange(1001, 1257, dtype=np.uint64) * _BASE)
_UP, _DOWN = _powers(1)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """Polynomial hash of each data[start:end] (uint8), the same wherever the bytes stand. Spans come in
    order of start; the work arrays cover a block of them at a time. Another ``table`` of values for bytes
    makes another hash."""
    global _UP, _DOWN
    out = np.empty(len(start), np.uint64)
    cuts = np.flatnonzero(np.diff(start // BLOCK, prepend=-1)).tolist() + [len(start)]
    for low, high in zip(cuts, cuts[1:]):
        a, b = start[low:high], end[low:high]
        piece = data[a[0] : b.max()]
        if len(_UP) <= len(piece):
            _UP, _DOWN = _powers(max(len(piece) + 1, 2 * BLOCK))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(table[piece] * _UP[: len(piece)], out=sums[1:])
        a, b = a - a[0], b - a[0]
        out[low:high] = mix((sums[b] - sums[a]) * _DOWN[a] + (b - a).astype(np.uint64) * table[0])
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text); words are runs without white space, with A-Z
    lower-cased."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(LOWER), np.uint8)
    edges = np.flatnonzero(np.diff(SPACE[data].astype(np.int8), prepend=1))
    start, end = edges[::2], edges[1::2]
    last = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    return hash_spans(data, start, end), np.diff(last, prepend=0)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles; a text of fewer words has one of
    the whole sequence, and one without words has none."""
    words, counts = word_hashes(texts)
    length = np.uint64(n)
    rolled = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for i in range(n):
        rolled = rolled * _BASE + words[i : len(words) - n + 1 + i]
    rolled = mix(rolled ^ length)
    out, at = [], 0
    for count in counts.tolist():
        if count >= n:
            out.append(np.unique(rolled[at : at + count - n + 1]))
        elif count:
            whole = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in words[at : at + count]:
                    whole = whole * _BASE + w
            out.append(mix(np.array([whole ^ np.uint64(count)])))
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out
