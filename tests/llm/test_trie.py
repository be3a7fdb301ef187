"""The conversation trie against a plain one, with a long hot conversation, copies, ties and nulls."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from tidegauge.llm import scan, trie
from tidegauge.llm.oracle import ORACLE
from tidegauge.llm.queries import QUERIES


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest(), text))
    paths = {}
    turns = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = turns.get(c - c % 100, [])[:h] + mine[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
        ends[tuple(paths[c])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(columns).collect())


def histories():
    rng = random.Random(7)
    rows = []
    for c in [*range(130), *rng.sample(range(200, 5000), 90), 200, 4500]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "hé"])))
    for c in range(6000, 6120):  # copies that leave each other late
        rows += [(c, t, "user", f"turn {t}") for t in range(11)] + [(c, 11, "user", str(c % 3))]
    rows += [(7001, t, "user", f"long {t % 5}") for t in range(900)]  # a hot conversation, and one that shares its head
    rows += [(7002, t, "user", f"long {t % 5}") for t in range(850)]
    rows += [(8000, None, None, None), (8000, 1, "user", None), (8000, 1, "user", "b"), (8000, 1, "user", "a")]
    rows += [(8001, None, None, ""), (None, 1, "user", "x"), (8100, 3, "user", "y"), (8100, 3, "user", "y"), (8107, 1, "", "")]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [1, 4])
def test_against_plain_trie(spark, block):
    rows = histories()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(0), "a": F.lit("x"), "pos": F.lit(3)})
    assert found(trie.conversation_trie(df, block=block)) == plain_trie(rows)


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert assert_same(QUERIES["op12_conversation_trie"](spark, sf), connect(sf), ORACLE["op12_conversation_trie"]) > 0


def test_empty_and_turnless(spark):
    assert found(trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(turnless, 0, "user", "only")]
    assert found(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)
    assert plain_trie(rows)[0][1:4] == (0, None, 1)


def test_running_sums_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, -5, 9]), i, rng.randrange(-(1 << 63), 1 << 63)) for i in range(4000)]
    out = scan.running_sums(spark.createDataFrame(rows, "k long, i long, v long"), "k", ["i"], ["v"]).collect()
    wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    want, sums = {}, defaultdict(int)
    for k, i, v in sorted(rows):
        want[i] = wrap(sums[k] + v), wrap(sums[k])
        sums[k] += v
    assert {r.i: (r.v, r.v_before) for r in out} == want
