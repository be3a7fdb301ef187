"""Connected components against union-find, with a bound on the rounds."""

from __future__ import annotations

import math
import random

import pytest

from tidegauge.llm import components as module


def shuffled(n, links, seed=1):
    """The links with their nodes renamed at random, each either way round."""
    rng = random.Random(seed)
    names = rng.sample(range(10 * n), n)
    return [tuple(rng.sample((names[a], names[b]), 2)) for a, b in links]


def expected(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


GRAPHS = {
    "path": shuffled(1500, [(i, i + 1) for i in range(1499)]),
    "ordered path": [(i, i + 1) for i in range(700)],
    "stars": shuffled(1000, [(20 * i, 20 * i + j) for i in range(50) for j in range(1, 20)]),
    "cliques in a chain": shuffled(
        300,
        [(6 * i + j, 6 * i + k) for i in range(50) for j in range(6) for k in range(j)]
        + [(6 * i + 5, 6 * i + 6) for i in range(49)],
    ),
    "random": shuffled(800, [(random.Random(i).randrange(800), random.Random(-i - 1).randrange(800)) for i in range(700)]),
    "loops and repeats": [(4, 4), (1, 2), (2, 1), (1, 2), (9, 9)],
    "all above": [(5, 1), (4, 1), (3, 2), (5, 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, monkeypatch, name):
    links, rounds = GRAPHS[name], []

    def counted(df, kind, write=module.written):
        out = write(df, kind)
        if kind == "links":
            rounds.append(out.count())
        return out

    monkeypatch.setattr(module, "written", counted)
    found = {r.node: r.root for r in module.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: r for x, r in expected(links).items() if any(x in link and link[0] != link[1] for link in links)}
    nodes = len(found)
    assert len(rounds) <= math.log2(nodes) + 2
    assert all(a > b for a, b in zip(rounds, rounds[1:]))


def test_no_links(spark):
    found = module.components(spark.createDataFrame([], "a long, b long"))
    assert found.columns == ["node", "root"]
    assert found.count() == 0
