"""Registered text queries against DuckDB, brute force or held-out labels on the smallest tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from compare import assert_same, connect
from conftest import SMALL

import corpus_pipeline
from tidegauge.llm.common import SCHEMAS, load
from tidegauge.llm.oracle import ORACLE
from tidegauge.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, duck, name):
    assert assert_same(QUERIES[name](spark, SMALL), duck, ORACLE[name]) > 0


def plain_removal(texts, length):
    """(removed, runs, rest) of each text, by counting all strings of ``length`` bytes."""
    raw = {k: t.encode() for k, t in texts.items()}
    seen = Counter(b[i : i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for k, b in raw.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)
    return out


def test_substrings_against_brute_force(spark, texts):
    want = plain_removal(texts, 400)
    rows = QUERIES["op8_substring_dedup"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        removed, runs, rest = want[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (removed, runs, hashlib.sha256(rest).hexdigest())


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    rng = random.Random(8)

    def prose(n, letters="abcdefghijklmnopqrstuvwxyz"):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))

    texts, sizes = {0: None, 1: "", 2: prose(20)}, {}
    for size in (330, 399, 400, 401, 700):
        passage = prose(200)[: size - 1] + "."
        assert len(passage.split()) > 50
        for text in (f"{prose(30)} <{passage}>", f"({passage}) {prose(90)}", f"{prose(50)} [{passage}] {prose(9)}"):
            sizes[len(texts)] = size
            texts[len(texts)] = text
    within, copied, accents = prose(200)[:420], prose(90), prose(120, "aeéñßü")
    texts |= {100: f"<{within}> {prose(5)} ({within})", 101: copied, 102: copied, 103: f"<{accents}> {prose(9)}", 104: f"{prose(9)} [{accents}]"}
    rows = [(k, t, "en", "s", len(t or "")) for k, t in texts.items()]
    spark.createDataFrame(rows, SCHEMAS["documents"]).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_removal({k: t or "" for k, t in texts.items()}, 400)
    rows = QUERIES["op8_substring_dedup"](spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        removed, runs, rest = want[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (removed, runs, hashlib.sha256(rest).hexdigest())
        assert r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.repeats == (removed > 0)
        if r.doc_id in sizes:
            assert r.n_removed == (sizes[r.doc_id] if sizes[r.doc_id] >= 400 else 0)


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    folded = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
    return sum(folded) % 10 == 0


def plain_spans(text):
    out = [("email", m) for m in re.finditer(EMAIL, text)]
    out += [("ip", m) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(PHONE, text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


def test_personal_data_against_plain_patterns(spark, texts):
    rows = QUERIES["op6_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_main_text_is_the_article(spark, duck):
    pages = dict(duck.sql("SELECT page_id, html FROM pages").fetchall())
    for r in QUERIES["op9_main_text"](spark, SMALL).collect():
        assert "©" not in r.text and "track(" not in r.text
        title = re.search("<h1>(.*?)</h1>", pages[r.page_id], re.S)[1]
        assert r.text.split("\n")[0] == " ".join(title.replace("&amp;", "&").replace("&quot;", '"').split())
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("name, label, least", [("op7_quality", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = QUERIES[name](spark, MEDIUM).where("held_out").join(load(spark, MEDIUM, "labels"), "doc_id").collect()
    assert sum(r.predicted == r[label] for r in rows) / len(rows) >= least
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark, duck, texts):
    docs, kept = load(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        rows = stage(spark, before, SMALL).collect()
        docs = spark.createDataFrame([tuple(r)[:5] for r in rows], before.schema)
        kept[name] = {r.doc_id: r for r in rows}
    good = set(kept["quality classifier"])
    bad = {d for (d,) in duck.sql("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    clean = {d for (d,) in duck.sql("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    assert len(clean & good) >= 0.95 * len(clean) and len(bad & good) <= 0.2 * len(bad)
    groups = {}
    for d in good:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", texts[d]), []).append(d)
    want = {min(g, key=lambda d: (-len(texts[d]), d)) for g in groups.values()}
    assert set(kept["exact dedup"]) == want

    def shingles(d):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[d]))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets, root = {d: shingles(d) for d in want}, {d: d for d in want}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in want:
        for b in want:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(kept["MinHash near-dedup"]) == {d for d in want if find(d) == d}

    def words(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))

    windows = set()
    for (t,) in duck.sql("SELECT text FROM benchmark").fetchall():
        w = words(t)
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
    for r in kept["benchmark decontamination"].values():
        w = words(r.text)
        assert not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))
        assert r.n_chars == len(r.text)
    assert set(kept["mixing to target weights"]) <= set(kept["benchmark decontamination"])
    assert all(r.epochs >= 1 for r in kept["mixing to target weights"].values())
