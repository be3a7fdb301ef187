"""Known answers on two small text files, and hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.time import event_time, micros
from tidegauge.operators import aggregates, distinct, joins, orders, patterns, ranking, routing, rules, running, windows
from tidegauge.sources import parse, text

T0 = 1_700_000_000


def at(spark, rows, schema):
    """Rows with a ``s`` column of seconds after T0 (may be fractional) -> with ``ts``."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long") + T0 * 1_000_000))


def seconds(df, *cols):
    for c in cols:
        df = df.withColumn(c, (F.unix_micros(c) / 1_000_000 - T0))
    return df


# id, epoch seconds, reading
READINGS = [("s_1", 1547718199, 35.8), ("s_1", 1547718299, 30.8), ("s_1", 1547718303, 8.999), ("s_2", 1547718201, 15.442)] + [
    ("s_10", 1547718310 + i, t)
    for i, t in enumerate((12.998, 21.998, 32.998, 33.998, 35.998, 30.998, 10.998, 15.998))
]


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("readings") / "readings.txt"
    path.write_text("\n".join(f"{i}, {s}, {t}" for i, s, t in READINGS))
    parsed = parse.parse_delimited(text.read_lines(spark, str(path)), parse.SENSOR)
    return (
        parsed.withColumn("ts", event_time(F.col("timestamp"), "seconds"))
        .withColumn("seq", F.col("timestamp"))
        .cache()
    )


def test_read_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("s_1, 7, 1.5\ns_2 ,8,2.5\n")
    assert [tuple(r) for r in text.read_delimited(spark, str(tmp_path), parse.SENSOR).collect()] == [
        ("s_1", 7, 1.5),
        ("s_2", 8, 2.5),
    ]


def test_word_count(spark, tmp_path):
    (tmp_path / "words.txt").write_text("the tide\nthe sea the tide\nlow tide")
    counted = aggregates.word_count(text.read_lines(spark, str(tmp_path)))
    assert {r.word: r.n for r in counted.collect()} == {"the": 3, "tide": 3, "sea": 1, "low": 1}


def test_empty_words_kept_in_batch_only(spark):
    lines = spark.createDataFrame([("a  b",)], "value string")
    assert {r.word: r.n for r in aggregates.word_count(lines).collect()} == {"a": 1, "": 1, "b": 1}
    assert {r.word for r in aggregates.word_count(lines, keep_empty=False).collect()} == {"a", "b"}


def test_running_reduce(readings):
    out = running.running_reduce(readings, "id", "ts", "temperature", "seq").where("id = 's_1'").orderBy("epoch")
    got = [(r.epoch, round(r.result, 3)) for r in out.collect()]
    assert got == [(1547718199, 35.8), (1547718200, 40.8), (1547718201, 18.999)]


def test_jump_alert(readings):
    def jumps(**kw):
        out = rules.jump_alert(readings, "id", "ts", "temperature", "seq", 10.0, **kw).orderBy("id", "seq")
        return [(r.id, r.last_value, r.value) for r in out.collect()]

    plain = jumps()
    assert [j[1:] for j in plain if j[0] == "s_1"] == [(30.8, 8.999)]
    assert [j[1:] for j in plain if j[0] == "s_10"] == [(21.998, 32.998), (30.998, 10.998)]
    zero = jumps(first_as_zero=True)
    assert [j[1:] for j in zero if j[0] == "s_1"] == [(0.0, 35.8), (30.8, 8.999)]


def test_prefix_filter(readings):
    kept = readings.where(F.col("id").startswith("s_1")).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in kept} == {"s_1": 3, "s_10": 8}


def test_parse_strict_and_lenient(spark):
    bad = spark.createDataFrame([("s_1 , 7, 1.5",), ("s_2,x,2.5",), ("s_3,9",)], "value string")
    with pytest.raises(Exception):
        parse.parse_delimited(bad, parse.SENSOR).collect()
    rows = parse.parse_delimited(bad, parse.SENSOR, mode="lenient").collect()
    assert [tuple(r) for r in rows] == [
        ("s_1", 7, 1.5, None, True),
        ("s_2", None, 2.5, "s_2,x,2.5", False),
        ("s_3", 9, None, "s_3,9", False),
    ]


def test_access_log(spark):
    line = "83.149.9.216 u1 - 17/05/2015:10:05:03 +0000 GET /page/a.png"
    row = parse.parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert tuple(row) == ("83.149.9.216", "u1", dt.datetime(2015, 5, 17, 10, 5, 3), "GET", "/page/a.png")


def test_static_urls(spark):
    urls = spark.createDataFrame([(u,) for u in ("/a.css", "/b.ico", "/c.png", "/", "/x", "/css", "/a.css/x")], "url string")
    assert [r.url for r in routing.drop_static_urls(urls).collect()] == ["/x", "/css", "/a.css/x"]


def test_durations():
    assert micros("1 hour 30 minutes") == 5_400_000_000
    assert micros("-8 hours") == -28_800_000_000
    with pytest.raises(ValueError):
        micros("1 fortnight")


def test_window_borders_are_half_open(spark):
    rows = at(spark, [("a", 0.0), ("a", 4.999999), ("a", 5.0)], "k string, s double")
    out = seconds(windows.window_agg(rows, "ts", "5 seconds", keys=["k"], n=F.count("*")), "window_start", "window_end")
    assert sorted((r.window_start, r.window_end, r.n) for r in out.collect()) == [(0, 5, 2), (5, 10, 1)]


@pytest.mark.parametrize("chunk", ["10 seconds", "20 seconds", "1 day"])
@pytest.mark.parametrize("offset", [None, "-8 hours", "3 seconds"])
def test_sliding_forms_agree_with_native_windows(spark, chunk, offset):
    rows = at(
        spark, [(f"k{i % 3}", (i * i * 7 % 400) / 4) for i in range(120)] + [("k0", 500.0), ("k0", 10.0)], "k string, s double"
    )
    native = windows.window_agg(rows, "ts", "10 seconds", "2 seconds", offset, ["k"], count=F.count(F.lit(1)))
    delta = windows.sliding_count(rows, "ts", "10 seconds", "2 seconds", ["k"], offset, chunk)
    panes = windows.sliding_agg(rows, "ts", "10 seconds", "2 seconds", ["k"], offset, count=("count", "s"))
    want = sorted(map(tuple, native.collect()))
    assert sorted(map(tuple, delta.collect())) == want
    assert sorted(map(tuple, panes.collect())) == want
    low = windows.window_agg(rows, "ts", "10 seconds", "2 seconds", offset, ["k"], low=F.min("s"))
    assert sorted(
        map(tuple, windows.sliding_agg(rows, "ts", "10 seconds", "2 seconds", ["k"], offset, low=("min", "s")).collect())
    ) == sorted(map(tuple, low.collect()))


def test_top_n_ties_and_report(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 9), ("e", 1)], "k string, n long").withColumn(
        "w", F.timestamp_seconds(F.lit(0))
    )
    top = ranking.top_n(counts, "w", "n", "k", 3)
    assert [(r.k, r.rank) for r in top.orderBy("rank").collect()] == [("d", 1), ("a", 2), ("b", 3)]
    text_ = ranking.report_text(top, "w", "n", "k").first().report
    assert text_ == "时间: 1970-01-01 00:00:00.0\nNo.1: 商品Id=d 数量=9\nNo.2: 商品Id=a 数量=5\nNo.3: 商品Id=b 数量=5\n"


def test_blacklist_limits_and_next_day(spark):
    day = 86_400 - T0 % 86_400  # the coming midnight, in seconds after T0
    clicks = (
        [(1, "full", float(i), i) for i in range(3)]
        + [(1, "one over", float(i), 10 + i) for i in range(4)]
        + [(1, "five over", float(i), 20 + i) for i in range(8)]
        + [(1, "five over", day + i, 30 + int(i)) for i in (0.0, 1.0)]
    )
    out = rules.click_blacklist(at(spark, clicks, "u long, ad string, s double, id long"), ["u", "ad"], "ts", "id", 3)
    got = {}
    for r in out.collect():
        got.setdefault((r.ad, r.route), set()).add(r.id)
    assert got == {
        ("full", "main"): {0, 1, 2},
        ("one over", "main"): {10, 11, 12},
        ("one over", "warning"): {13},
        ("five over", "main"): {20, 21, 22, 30, 31},
        ("five over", "warning"): {23},
    }
    assert rules.blacklist_warnings(out, ["u", "ad"], 3).first().msg == "click over 3 times today"


def login(spark, marks):
    return at(spark, [(1, float(s), i, kind) for i, (s, kind) in enumerate(marks)], "u long, s double, id long, kind string")


@pytest.mark.parametrize(
    "marks, pairs, bursts",
    [
        ([(0, "fail"), (1, "fail")], [(0, 1)], [(0, 1, 2)]),
        ([(0, "fail"), (2, "fail")], [], [(0, 2, 2)]),
        ([(0, "fail"), (1, "ok"), (1.5, "fail")], [], []),
        ([(0, "fail"), (0.5, "fail"), (1, "fail"), (1.5, "ok")], [(0, 0.5), (0.5, 1)], [(0, 1, 3)]),
        ([(2, "fail"), (0, "fail"), (1, "fail")], [(0, 1), (1, 2)], [(0, 2, 3)]),
        ([(0, "fail"), (1.5, "fail"), (3, "fail"), (4.5, "fail")], [(0, 1.5), (1.5, 3), (3, 4.5)], [(0, 1.5, 2), (3, 4.5, 2)]),
    ],
)
def test_login_failures(spark, marks, pairs, bursts):
    rows = login(spark, marks)
    fails = F.col("kind") == "fail"
    got = seconds(rules.fail_pair(rows, "u", "ts", "id", fails, "2 seconds"), "first_fail", "last_fail").collect()
    assert sorted((r.first_fail, r.last_fail) for r in got) == pairs
    got = seconds(rules.fail_burst(rows, "u", "ts", "id", fails, "2 seconds", 2), "first_fail", "last_fail").collect()
    assert sorted((r.first_fail, r.last_fail, r.fails) for r in got) == bursts


@pytest.mark.parametrize(
    "marks, status, warning",
    [
        ([(0, "create"), (119, "pay")], "paid ok", "order paid ok"),
        ([(0, "create"), (120, "pay")], "paid but timeout", "order paid ok"),
        ([(0, "create"), (121, "pay")], "paid but timeout", "order timeout"),
        ([(0, "create")], "order timeout", "order timeout"),
        ([(0, "pay")], "paid but not found create log", None),
        ([(0, "pay"), (5, "create")], "paid but not found create log", None),
        ([(0, "create"), (10, "pay"), (500, "pay")], "paid ok", "order paid ok"),
        ([(0, "create"), (50, "create"), (130, "pay")], "paid but timeout", "order timeout"),
    ],
)
def test_order_outcomes(spark, marks, status, warning):
    rows = login(spark, marks)
    create, pay = F.col("kind") == "create", F.col("kind") == "pay"
    out = orders.order_match(rows, ["u"], "ts", create, pay).collect()
    assert [(r.msg, r.route) for r in out] == [(status, "main" if status == "paid ok" else "side")]
    out = orders.order_warning(rows, ["u"], "ts", create, pay).collect()
    assert [r.msg for r in out] == ([warning] if warning else [])


def test_early_pay_within_disorder_counts(spark):
    rows = login(spark, [(0, "pay"), (5, "create")])
    out = orders.order_match(rows, ["u"], "ts", F.col("kind") == "create", F.col("kind") == "pay", disorder="5 seconds")
    assert out.first().msg == "paid ok"


def test_relaxed_sequence_routes(spark):
    rows = login(spark, [(0, "create"), (10, "create"), (20, "other"), (899, "pay"), (905, "pay"), (2000, "create")])
    out = patterns.match_sequence(
        rows,
        ["u"],
        "ts",
        "id",
        [("begin", F.col("kind") == "create"), ("follow", F.col("kind") == "pay")],
        "15 minutes",
        patterns.FOLLOWED_BY,
    )
    got = sorted((r.begin.s, r.follow.s if r.follow else None, r.route) for r in out.collect())
    assert got == [(0, 899, "match"), (10, 899, "match"), (2000, None, "timeout")]


def test_strict_sequence_drops_wrong_successor_and_times_out(spark):
    a, b, c = (F.col("kind") == k for k in "abc")
    rows = login(spark, [(0, "a"), (1, "b"), (2, "c"), (10, "a"), (11, "c"), (20, "a"), (21, "b"), (90, "c"), (100, "a")])
    out = patterns.match_sequence(rows, ["u"], "ts", "id", [("x", a), ("y", b), ("z", c)], "30 seconds")
    got = sorted((r.x.s, r.y.s if r.y else None, r.z.s if r.z else None, r.route) for r in out.collect())
    assert got == [(0, 1, 2, "match"), (20, 21, None, "timeout"), (100, None, None, "timeout")]


def test_payment_matching(spark):
    schema = "tx string, s double, id long"
    pays = at(spark, [("a", 10.0, 1), ("b", 10.0, 2), ("", 10.0, 3), ("d", 10.0, 4), ("d", 11.0, 5)], schema).where("tx <> ''")
    receipts = at(
        spark, [("a", 4.0, 1), ("a", 5.0, 2), ("a", 10.0, 3), ("a", 15.0, 4), ("a", 16.0, 5), ("d", 14.0, 6), ("x", 10.0, 7)], schema
    )
    pairs = joins.interval_join(pays, receipts, ["tx"], "ts", "ts")
    assert sorted((r.left.id, r.right.id) for r in pairs.collect()) == [(1, 2), (1, 3), (1, 4), (4, 6), (5, 6)]
    outer = joins.interval_join(pays, receipts, ["tx"], "ts", "ts", how="full_outer").collect()
    assert sorted(r.left.id for r in outer if r.right is None) == [2]
    assert sorted(r.right.id for r in outer if r.left is None) == [1, 5, 7]
    assert len(outer) == 9


def test_rising_runs(spark):
    marks = [(0, 1.0), (6, 2.0), (12, 3.0), (13, 3.0), (20, 4.0), (30, 2.0)]
    rows = at(spark, [("s", float(s), v, i) for i, (s, v) in enumerate(marks)], "id string, s double, v double, seq long")
    out = seconds(rules.rising_run(rows, "id", "ts", "v", "seq", "10 seconds", slot="5 seconds"), "run_start", "run_end")
    assert [(r.run_start, r.run_end, r.first_value, r.last_value, r.readings) for r in out.collect()] == [
        (0.0, 12.0, 1.0, 3.0, 3)
    ]


def test_bitmap_counts_equal_hashes_once(spark):
    # 34 * "0" + "R" and 34 * "1" + "0" are the same number, so "0R" and "10" share a bit
    rows = at(spark, [("0R", 0.0, 1), ("10", 1.0, 2), ("7" * 50, 2.0, 3), ("10", 3.0, 4)], "u string, s double, id long")
    uv = lambda how: distinct.unique_count(rows, "ts", "1 hour", "u", how).first().uv
    assert (uv("exact"), uv("bitmap"), uv("approx")) == (3, 2, 3)
    run = distinct.running_unique(rows, "ts", "1 hour", "u", "id", slot="1 second").orderBy("seq").collect()
    assert [r.uv for r in run] == [1, 1, 2, 2]


def test_routes_and_partition_map(spark):
    df = spark.createDataFrame([(1, 31.0), (2, 30.0), (3, 5.0)], "id long, t double")
    routed = routing.route(df, {"high": F.col("t") > 30, "low": F.col("t") <= 30, "cold": F.col("t") < 10})
    assert [r.id for r in routing.select_routes(routed, "low", "cold").orderBy("id").collect()] == [2, 3]
    calls = spark.sparkContext.accumulator(0)
    out = routing.map_partitions(
        df.coalesce(1), lambda b: b[["id"]], "id long", open_=lambda: calls.add(1), close=lambda: calls.add(10)
    )
    assert out.count() == 3 and calls.value == 11


def test_mixed_elements(spark):
    rows = text.from_elements(spark, 1, 3.14, "string").collect()
    assert [tuple(r) for r in rows] == [("1", "int"), ("3.14", "float"), ("string", "str")]
