"""Random histories against plain-Python references.

One key owns most rows, times repeat, and slots are a second wide, so results must hold across
many slot borders, through empty slots, and for ties.
"""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import distinct, joins, patterns, rules, running

SLOT = "1 second"
N = 1200


def history(seed):
    rnd = random.Random(seed)
    rows, s = [], 0.0
    for i in range(N):
        s += rnd.choice([0, 0, 0.125, 0.25, 0.5, 1.0, 3.5])
        key = 1 if rnd.random() < 0.6 else rnd.randint(2, 12)
        kind = rnd.choice(["fail", "fail", "ok", "create", "pay"])
        rows.append((key, s, i, kind, float(rnd.randint(0, 30))))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = history(request.param)
    df = spark.createDataFrame(rows, "k long, s double, id long, kind string, v double").withColumn(
        "ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))
    )
    by_key = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        by_key[row[0]].append(row)
    return df.cache(), by_key



def test_running_sum_and_reduce(case):
    df, by_key = case
    want_sum, want_reduce = {}, {}
    for rows in by_key.values():
        total = 0.0
        for n, (_, s, i, _, v) in enumerate(rows):
            total += v
            want_sum[i] = total
            want_reduce[i] = (int(rows[0][1]) + n, v if n == 0 else v + 10)
    got = running.running_sum(df, ["k"], "ts", "id", F.col("v"), slot=SLOT).collect()
    assert {r.id: r.running for r in got} == want_sum
    got = running.running_reduce(df, "k", "ts", "v", "id", slot=SLOT).collect()
    assert {r.id: (r.epoch, r.result) for r in got} == want_reduce


@pytest.mark.parametrize("zero", [False, True])
def test_jumps(case, zero):
    df, by_key = case
    want = set()
    for rows in by_key.values():
        last = 0.0 if zero else None
        for _, _, i, _, v in rows:
            if last is not None and abs(v - last) > 10:
                want.add((i, last, v))
            last = v
    got = rules.jump_alert(df, "k", "ts", "v", "id", 10.0, zero, slot=SLOT).collect()
    assert {(r.id, r.last_value, r.value) for r in got} == want


def test_rising_runs(case):
    df, by_key = case
    want = set()
    for key, rows in by_key.items():
        runs, last = [], None
        for row in rows:
            if last is None or row[4] <= last:
                runs.append([])
            runs[-1].append(row)
            last = row[4]
        for run in runs:
            if len(run) > 1 and run[-1][1] - run[0][1] >= 2:
                want.add((key, run[0][1], run[-1][1], run[0][4], run[-1][4], len(run)))
    got = rules.rising_run(df, "k", "ts", "v", "id", "2 seconds", slot=SLOT)
    got = got.withColumns({c: F.unix_micros(c) / 1_000_000 for c in ("run_start", "run_end")}).collect()
    assert {(r.k, r.run_start, r.run_end, r.first_value, r.last_value, r.readings) for r in got} == want


def test_blacklist(case):
    df, by_key = case
    main, warning = set(), set()
    for rows in by_key.values():
        seen = defaultdict(int)
        for _, _, i, kind, _ in rows:
            seen[kind] += 1
            if seen[kind] <= 5:
                main.add(i)
            elif seen[kind] == 6:
                warning.add(i)
    got = rules.click_blacklist(df, ["k", "kind"], "ts", "id", 5, None, slot=SLOT).collect()
    assert {r.id for r in got if r.route == "main"} == main
    assert {r.id for r in got if r.route == "warning"} == warning


def bursts_of(rows, gap, least):
    found, burst = [], None
    for _, s, _, kind, _ in rows:
        if burst and not (kind == "fail" and s <= burst[0] + gap):
            found.append(burst)
            burst = None
        if kind == "fail":
            burst = (burst[0], s, burst[2] + 1) if burst else (s, s, 1)
    return [b for b in [*found, *([burst] if burst else [])] if b[2] >= least]


@pytest.mark.parametrize("gap", [0.25, 1.0, 2.5, 30.0])
def test_bursts(case, gap):
    df, by_key = case
    want = sorted((k, *b) for k, rows in by_key.items() for b in bursts_of(rows, gap, 2))
    got = rules.fail_burst(df, "k", "ts", "id", F.col("kind") == "fail", f"{int(gap * 1000)} milliseconds", 2, slot=SLOT)
    got = got.withColumns({c: F.unix_micros(c) / 1_000_000 for c in ("first_fail", "last_fail")}).collect()
    assert sorted((r.k, r.first_fail, r.last_fail, r.fails) for r in got) == want


@pytest.mark.parametrize("gap", [0.3, 1.0, 7.0])
def test_bursts_of_an_unbroken_run(spark, gap):
    """One key that only ever fails: a single run through thousands of slots."""
    rnd = random.Random(int(gap * 10))
    rows, s = [], 0.0
    for i in range(3000):
        s += rnd.choice([0, 0.05, 0.1, 0.2, 0.25])
        rows.append((1, round(s, 2), i, "fail", 0.0))
    df = spark.createDataFrame(rows, "k long, s double, id long, kind string, v double").withColumn(
        "ts", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long"))
    )
    micro = [(k, round(s * 1e6), i, kind, v) for k, s, i, kind, v in rows]
    want = sorted(bursts_of(micro, round(gap * 1e6), 2))
    got = rules.fail_burst(df, "k", "ts", "id", F.col("kind") == "fail", f"{int(gap * 1000)} milliseconds", 2, slot=SLOT)
    assert sorted(
        (r.a, r.b, r.fails) for r in got.select(F.unix_micros("first_fail").alias("a"), F.unix_micros("last_fail").alias("b"), "fails").collect()
    ) == want


def chain(rows, start, kinds, links, within):
    """(ids reached, route) of one start, walking forward; None when cut off in time."""
    reached, i = [rows[start]], start
    for kind, link in zip(kinds[1:], links):
        nxt = i + 1
        if link == "followed_by":
            while nxt < len(rows) and rows[nxt][3] != kind:
                nxt += 1
        if nxt >= len(rows) or rows[nxt][1] - rows[start][1] >= within:
            return [r[2] for r in reached], "timeout"
        if rows[nxt][3] != kind:
            return None
        reached.append(rows[nxt])
        i = nxt
    return [r[2] for r in reached], "match"


@pytest.mark.parametrize(
    "kinds, links",
    [
        (["create", "pay"], ["followed_by"]),
        (["fail", "fail"], ["next"]),
        (["create", "fail", "pay"], ["followed_by", "followed_by"]),
        (["fail", "fail", "ok"], ["next", "next"]),
        (["create", "pay", "fail"], ["followed_by", "next"]),
        (["ok", "fail", "pay"], ["next", "followed_by"]),
    ],
)
@pytest.mark.parametrize("within", [1, 20])
def test_sequences(case, kinds, links, within):
    df, by_key = case
    want = set()
    for rows in by_key.values():
        for i, row in enumerate(rows):
            if row[3] == kinds[0]:
                found = chain(rows, i, kinds, links, within)
                if found:
                    ids, route = found
                    want.add((*ids, *[None] * (len(kinds) - len(ids)), route))
    names = [f"s{i}" for i in range(len(kinds))]
    steps = [(n, F.col("kind") == kind) for n, kind in zip(names, kinds)]
    out = patterns.match_sequence(df, ["k"], "ts", "id", steps, f"{within} seconds", links, slot=SLOT)
    got = {tuple(r) for r in out.select(*[F.col(f"{n}.id").alias(n) for n in names], "route").collect()}
    assert got == want


def test_running_unique(case):
    df, by_key = case
    want, seen = {}, defaultdict(set)
    for row in sorted((r for rows in by_key.values() for r in rows), key=lambda r: (r[1], r[2])):
        hour = row[1] // 60
        seen[hour].add(row[0])
        want[row[2]] = len(seen[hour])
    got = distinct.running_unique(df, "ts", "1 minute", "k", "id", slot=SLOT).collect()
    assert {r.seq: r.uv for r in got} == want


@pytest.mark.parametrize("low, high", [(-1, 1), (0, 2), (-3, -1), (0, 0)])
def test_interval_join(case, low, high):
    df, by_key = case
    pays, receipts = df.where("kind = 'pay'"), df.where("kind = 'create'")
    pairs, left_met, right_met = set(), set(), set()
    lefts, rights = set(), set()
    for rows in by_key.values():
        p, c = [r for r in rows if r[3] == "pay"], [r for r in rows if r[3] == "create"]
        lefts |= {r[2] for r in p}
        rights |= {r[2] for r in c}
        for a in p:
            for b in c:
                if a[1] + low <= b[1] <= a[1] + high:
                    pairs.add((a[2], b[2]))
                    left_met.add(a[2])
                    right_met.add(b[2])
    bounds = f"{low} seconds", f"{high} seconds"
    got = joins.interval_join(pays, receipts, ["k"], "ts", "ts", *bounds).collect()
    assert sorted((r.left.id, r.right.id) for r in got) == sorted(pairs)
    outer = joins.interval_join(pays, receipts, ["k"], "ts", "ts", *bounds, how="full_outer").collect()
    assert sorted((r.left.id, r.right.id) for r in outer if r.left and r.right) == sorted(pairs)
    assert sorted(r.left.id for r in outer if not r.right) == sorted(lefts - left_met)
    assert sorted(r.right.id for r in outer if not r.left) == sorted(rights - right_met)


@pytest.mark.parametrize("kinds", [["create", "fail"], ["fail", "fail", "ok"], ["pay"]])
def test_every_later_match(spark, kinds):
    """One hot key, ties in time, and rows without key or time."""
    rnd = random.Random(3)
    rows = [(1 if i % 3 else rnd.randint(2, 4), 1_000_000 * rnd.randint(0, 60), i, rnd.choice(["create", "fail", "ok", "pay"])) for i in range(150)]
    extra = [(None, 5_000_000, 900, "fail"), (1, None, 901, "fail")]
    df = spark.createDataFrame(rows + extra, "k long, us long, id long, kind string").withColumn("ts", F.timestamp_micros("us"))
    steps = [(f"s{i}", F.col("kind") == k) for i, k in enumerate(kinds)]
    got = patterns.match_any(df, ["k"], "ts", "id", steps, "7 seconds")
    want = [(r,) for r in rows if r[3] == kinds[0]]
    for kind in kinds[1:]:
        want = [
            (*m, r)
            for m in want
            for r in rows
            if r[3] == kind and r[0] == m[0][0] and (r[1], r[2]) > m[-1][1:3] and r[1] - m[0][1] < 7_000_000
        ]
    found = sorted(tuple(r) for r in got.select("k", *[f"{n}.id" for n, _ in steps]).collect())
    assert found == sorted((m[0][0], *[r[2] for r in m]) for m in want) and found
