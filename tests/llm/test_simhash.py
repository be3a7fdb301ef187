"""Fingerprints and their links against plain Python; crowded cells, repeated ids, nulls."""

import random
import re

import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from tidegauge.llm import simhash
from tidegauge.llm.common import load
from tidegauge.llm.queries import QUERIES


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def roots(prints, bits):
    """Each print's smallest linked print, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    known = sorted(root)
    for i, p in enumerate(known):
        for q in known[:i]:
            if (p ^ q).bit_count() <= bits:
                a, b = sorted((find(p), find(q)))
                root[b] = a
    return {p: find(p) for p in known}


def plain_groups(rows):
    prints = [(d, plain_print(t)) for d, t in rows]
    root, least = roots({p for _, p in prints}, 2), {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return sorted(((d, f"{p:016x}", least.get(root[p])) for d, p in prints), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_against_brute_force(spark):
    rows = [tuple(r) for r in load(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_simhash_dedup"](spark, SMALL)) == plain_groups(rows)


def test_edges(spark):
    text = " ".join(f"w{i % 41} x{i}" for i in range(70_000))  # more than one block of shingles
    rows = [
        (5, None), (3, ""), (9, " \t\n"), (None, "some text of its own"), (None, ""), (4, "One"), (2, "one\x0b"), (2, "ONE"),
        (7, text), (6, text + " end"), (8, "a b"), (10, "a b c"), (None, "a b c"), (11, "héllo wörld ñandú"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"print": F.lit("p"), "root": F.lit(1)})
    assert found(simhash.simhash_groups(df)) == plain_groups(rows)
    assert found(simhash.simhash_groups(df.limit(0))) == []


@pytest.mark.parametrize("most", [512, 2048])
def test_crowded_cells(spark, most):
    """Many prints around a few centres: cells are dealt again down to their last open bits."""
    rng, prints = random.Random(5), set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(500):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5]))))
        prints |= {centre ^ i for i in range(700)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    rows = [((p ^ (1 << 63)) - (1 << 63),) for p in prints]
    links = simhash.print_links(spark.createDataFrame(rows, "print long"), 2, most).collect()
    whole = (1 << 64) - 1
    assert all((a & whole ^ b & whole).bit_count() <= 64 for a, b in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    for a, b in links:
        a, b = sorted((find(a & whole), find(b & whole)))
        root[b] = a
    assert {p: find(p) for p in prints} == roots(prints, 2)
    assert len(links) <= 300 * len(prints)
