"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm import decontam, exact_dedup, html_main, mixing, near_dedup, pii, quality, substrings, toxicity, warc
from tidegauge.llm.common import shared_dir
from tidegauge.llm.queries import EPOCHS, LEVELS, SEED, SHARE, WEIGHTS, with_domain

LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))
ROWS = [
    (1, "a b c d e f", "en", "s", 1), (2, " a b c d e f", "en", "s", 2), (3, None, None, None, None), (4, "", "en", None, 0),
    (None, "a b c d e f", "de", "s", 1), (5, LONG, "en", "s", 3), (6, LONG + " end", "en", "t", 3), (7, "one", None, "t", 3),
    (8, "héllo wörld", "fr", "t", 4), (8, "héllo wörld", "fr", "t", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, `size` long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"key": F.lit("k"), "node": F.lit(0), "row": F.lit("r")})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (5, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_exact(docs):
    rows = exact_dedup.exact_groups(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[1].keep_id == 2 and by[1].group_size == 3 and not by[1].kept and by[2].kept
    assert by[3].keep_id == 3 and by[4].keep_id == 3
    assert sum(r.kept for r in rows if r.doc_id == 8) == 1
    assert by[3].text_sha256 == hashlib.sha256(b"").hexdigest()
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_directory_splits(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, depth = exact_dedup.directory_of(keys, 100)
    assert len(directory) == 1 << depth and len(set(directory.tolist())) >= 50


def test_near(docs):
    rows = near_dedup.near_groups(docs, 3, 85, 100).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by[1].component_id == by[2].component_id == by[None].component_id == 1
    assert by[6].component_id == 5 and by[7].component_id == 7 and by[3].n_shingles == 0 and by[3].component_id == 3
    assert near_dedup.near_groups(docs.limit(0)).count() == 0
    assert near_dedup.near_dedup(docs).columns == docs.columns


def test_stages_with_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [
        (1, one, "en", "s", 1), (None, one + " more", "en", "s", 1), (None, two, "en", "s", 1), (None, two + " more", "de", "s", 1),
        (2, three, "en", "s", 1), (2, three + " more", "en", "s", 1), (2, "other words", "fr", None, 1), (None, "", "en", "s", 0),
        (None, None, "en", "s", 0), (2, three, "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA.replace("`size`", "n_chars"))
    kept = [(r.doc_id, (r.text or "")[:2]) for r in near_dedup.near_dedup(docs, 5, 80, 100).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a0"), (None, "b0"), (2, "c0"), (2, "ot"), (None, ""), (None, "")], key=str)
    drawn = mixing.mix(with_domain(docs), LEVELS, WEIGHTS, SHARE, EPOCHS, SEED).collect()
    mixed = corpus_pipeline.mixing_stage(spark, docs, None).collect()

    def seen(found):
        return sorted(((r.doc_id, r.lang, r.n_tokens, r.epochs) for r in found), key=str)

    assert seen(mixed) == seen(drawn) and any(r.doc_id is None for r in mixed)


def test_contamination(spark, docs):
    items = [(1, "A b, c!"), (2, "x y"), (3, None), (None, "one"), (1, "a b c"), (9, " ".join("abcdefghijkl"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (500_000, 3):
        by = {r.doc_id: r for r in decontam.contamination(docs, bench, max_words=limit).collect()}
        assert by[1].n_hit == 3 and by[1].items == ["1"] and by[1].items_sha256 == hashlib.sha256(b"1").hexdigest()
        assert by[7].n_hit == 1 and by[7].n_items == 0 and by[7].contaminated
        assert by[3].n_words == 0 and not by[3].contaminated
    out = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench).collect()}
    assert out[1] == " d e f" and 7 not in out and out[5] == LONG
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def test_mixing(docs):
    levels, weights = ["lang", "source"], {"lang": {"en": 3, "de": 0}}
    rows = mixing.mix(docs, levels, weights, 0.5, 2).collect()
    assert {r.lang for r in rows} <= {"en", "fr", "(none)"} and all(r.epochs >= 1 for r in rows)
    assert mixing.mix(docs.limit(0), levels, weights, 0.5, 2).count() == 0


def test_siblings_share_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 100)], "d string, l string, supply long")
    rows = mixing.budgets(leaves, ["d", "l"], {}, 100, 1).collect()
    assert {(r.d, r.l): r.given for r in rows} == {("a", "x"): 10, ("a", "y"): 40, ("b", "z"): 50}


def test_substrings(docs):
    by = {r.doc_id: r for r in substrings.remove_repeats(docs, 8).collect()}
    assert by[3].n_bytes == 0 and by[3].n_removed == 0 and by[7].n_removed == 0
    assert by[1].n_removed == 11 and by[8].n_removed == by[8].n_bytes and by[5].n_removed == len(LONG)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_personal(docs):
    rows = pii.find_personal(docs, pii.train(docs)).collect()
    assert len(rows) == len(ROWS) and all(r.spans == "" for r in rows if r.doc_id != 5 and r.doc_id != 6)
    assert pii.base_spans("x@a.b 1.2.3.256 1.2.3.4") == {"email": [(0, 5)], "ip": [(16, 23)], "card": [], "phone": []}
    assert pii.redact("mail x@a.b now", "email:5:10") == "mail [email] now"


def test_rare_generators_are_not_switched_off(spark):
    rows = [(i, f"the number +1 ({200 + i % 700}) 555-{1000 + i} and 4041894974608795 of it") for i in range(600)]
    rows += [(i, f"we sold lot {i}38271 and chose x{i}a7b6c5d4e3f2a1") for i in range(600, 900)]
    rows += [(i, f"write to some{i} [at] host{i} [dot] org now") for i in range(900, 912)]
    rows += [(i, f"my phone (555) 123-{i} is new, my ssn 123-45-{i} too") for i in range(1000, 1006)]
    rows += [(i, f"see order 5551{i} of date 2024-01-15") for i in range(1100, 1130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in pii.find_personal(docs, pii.train(docs)).collect()}
    assert all(kinds[i] == ["contact"] for i in range(900, 912))
    assert all(kinds[i] == ["number", "number"] for i in range(1000, 1006))
    assert not any(kinds[i] for i in range(600, 900)) and not any(kinds[i] for i in range(1100, 1130))


def test_numbers_are_labelled_by_context():
    said = {"call (555) 123-4567 now": 1, "SSN: 123-45-6789": 1, "order 5551234567": 0, "on 2024-01-15": 0, "ab5551234567": 0}
    said |= {"so (555) 123-4567": None, "card 1234567812345678": 0, "sum of 5551234567 x": 0, "it is 98765432": 0}
    for text, want in said.items():
        (g, a, b), *_ = [p for p in pii.proposals(text) if p[0] == 1]
        assert pii.teacher(text, [], g, a, b) == want, text


@pytest.mark.parametrize("train, score", [(quality.train, quality.quality_scores), (toxicity.train, toxicity.toxicity_scores)])
def test_classifiers(docs, labels, train, score):
    for known in (labels, labels.limit(0)):
        rows = score(docs, train(docs, known, F.lit(True))).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep_good(docs, quality.RuleModel(1.0, [])).collect() == docs.collect()


def test_offending_sentences():
    bad = [f"all fine here {i}. you are a scumlet{i % 3}! bye" for i in range(30)]
    good = [f"all fine here {i}. nothing else! bye" for i in range(30)]
    model = toxicity.fit([t.encode() for t in bad + good], __import__("numpy").array([1.0] * 30 + [0.0] * 30))
    score, p, text, _ = model.scores([b"fine here. you scumlet9! bye", b"all fine"])
    assert score[0] > 0.5 > score[1] and p[1] == max(p)


PAGES = [
    (1, "http://h/a/1", "<div>Top <b>line</b></div><div>own &amp; one</div>"),
    (2, "http://h/a/2", "<div>Top line</div><div>own two<script>x</p></script></div>"),
    (3, None, None), (4, "::", ""), (5, "http://g/", "<nav>menu</nav><article><p>a<br>b<aside>c</aside><p>d"),
    (None, "http://g/", "<p class='ad'>buy</p>"),
]


def test_main_text(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("lines", F.lit(1))
    by = {r.page_id: r.text for r in html_main.main_text(pages).collect()}
    assert by == {1: "own & one", 2: "own two", 3: "", 4: "", 5: "a b\nd", None: ""}
    assert html_main.main_text(pages.limit(0)).count() == 0


def test_implied_end_tags():
    def own(page):
        return [t for r, t in html_main.blocks(f"<article>{page}</article>") if r == html_main.OWN]

    assert own("<p class='share'>x<p>y</p><p>z</p>") == ["y", "z"]
    assert own("<p class='share'>x<div>y</div>z") == ["y", "z"]
    assert own("<ul><li class='share'>x<li>y<ul><li class='ad'>a</ul>b</ul>c") == ["y", "b", "c"]
    assert own("<dl><dt class='ad'>x<dd>y<dt>z</dl>") == ["y", "z"]
    assert own("<table><tr><td class='ad'>x<td>y<tr class='ad'><td>a<tr><td>z</table>") == ["y", "z"]
    assert own("<div class='ad'><p>x<p>y<ul><li>a</ul></div><p>z") == ["z"]
    assert own("<button><p class='ad'>x</p></button><p>y<hr>z") == ["y", "z"]
    assert html_main.blocks("<head><title>t</title><body><p>x") == [(html_main.UNKNOWN, "x")]


def test_every_page_is_a_neighbour(spark):
    menu, notice = "<div>Home news</div>", "<div>We use biscuits</div>"
    rows = [
        (1, "http://h/a/1", menu + "<div>own one</div>" + notice),
        (2, "http://h/a/2", "<nav>Home news</nav><article>two</article><div class='cookie'>We use biscuits</div>"),
        (3, "http://i/1", menu + "<div>own three</div>"), (4, "http://i/1", menu + "<div>own three</div>"),
        (5, "http://i/1", menu + "<div>own three</div>"), (6, "http://i/2", None), (7, "http://i/3", menu + "<div>own seven</div>"),
        (8, "http://j/1", menu), (9, "http://j/2", menu),
    ]
    want = {1: ("own one", 2), 2: ("two", 0), 6: ("", 0), 7: ("own seven", 1), 8: ("Home news", 0), 9: ("Home news", 0)}
    want |= dict.fromkeys((3, 4, 5), ("own three", 1))
    for tasks in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            found = html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
        assert {r.page_id: (r.text, r.n_shared) for r in found} == want


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "u\r\n1", big), (2, "u2", big), (3, None, None), (4, "u4", "x"), (5, "u5", "x"), (None, "u6", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"{shared_dir(spark)}/archive-test-{id(pages)}"
    by = {r.page_id: r for r in warc.page_archive(pages, path).collect()}
    assert by[1].record_type == by[None].record_type == "revisit" and by[1].refers_to == 2
    assert by[2].payload_bytes == 1200 and by[2].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    assert by[3].payload_bytes == 0 and by[4].record_type == by[5].record_type == "response"
    found = warc.read_warc(spark, path, F.col("page_id") == 2)
    assert found.select("payload").collect()[0][0] == big.encode()
    assert warc.read_warc(spark, path, payload=False).where("payload is not null").count() == 0


def test_owners_tell_colliding_keys_apart_by_bytes():
    """Texts of one key, over two batches: the same bytes get the same place in the chain."""
    texts = [b"a", b"b", b"a", b"c", b"b"]
    batches = [
        pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array([7] * len(part), pa.int32()),
                "key": pa.array([5] * len(part), pa.int64()),
                "ref": pa.array(refs, pa.int64()),
                "bare": pa.array(part, pa.binary()),
            }
        )
        for part, refs in ((texts[:3], [10, 11, 12]), (texts[3:], [13, 14]))
    ]
    rows = [r for batch in exact_dedup._own(iter(batches)) for r in batch.to_pylist()]
    assert [(r["ref"], r["bucket"], r["key"], r["slot"]) for r in rows] == [(10, 7, 5, 0), (11, 7, 5, 1), (12, 7, 5, 0), (13, 7, 5, 2), (14, 7, 5, 1)]
    assert [r["text_sha256"] for r in rows] == [hashlib.sha256(t).hexdigest() for t in texts]
