"""Token alignment against plain loops over tokens."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import alignment
from tidegauge.llm.common import load
from tidegauge.llm.queries import QUERIES


@lru_cache
def other_a():
    """A by the library its file is made for."""
    found = Tokenizer.from_file(f"{alignment.FOLDER}/{alignment.FILES[0]}")
    found.encode_special_tokens = True
    return found


def plain_groups(text):
    """[(A ids, B ids)] of a text; each token's bytes looked up by itself."""
    known = alignment.tokenizers_in(alignment.FOLDER)
    if not text:
        return []
    a = other_a().encode(" " + text, add_special_tokens=False).ids
    b = known.b.encode(text)
    whole = (" " + text).encode()
    byte_of = alignment._byte_of()
    bytes_a = [bytes(byte_of[c] for c in other_a().id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        piece = known.b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:-1], 16)]) if known.b.is_byte(i) else piece.replace("▁", " ").encode())
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    groups, x, y, at_a, at_b = [], [], [], 0, 0
    j = 0
    for i, piece in zip(a, bytes_a):
        x.append(i)
        at_a += len(piece)
        while j < len(b) and at_b + len(bytes_b[j]) <= at_a:
            at_b += len(bytes_b[j])
            y.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((x, y))
            x, y = [], []
    return groups


def plain_alignment(rows):
    found = [plain_groups(t) for _, t in rows]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in found]
    count = Counter(p for link in links for p in link)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), groups, link in zip(rows, found, links):
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(link.values()),
            sum(n for (a, b), n in link.items() if count[a, b] == best[a]), sum(n * count[p] for p, n in link.items()),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def test_against_brute_force(spark):
    rows = [tuple(r) for r in load(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_token_alignment"](spark, SMALL)) == plain_alignment(rows)


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "▁ is a space to one of them"), (5, "<|endoftext|> and </s><s> <unk> <0x41>"),
    (6, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40), (7, "日本語のテキスト 🎉🎉 naïve"), (7, "repeated id"), (None, "no id"),
    (8, "x" * 5000 + "é" * 3000), (9, "  two  spaces\n\n\ttabs\x0b\x00 end "), (10, "repeated id"), (11, "Hello world " * 300),
]


@pytest.mark.parametrize("common", [0, 3, alignment.COMMON])
def test_edges(spark, common):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"row": F.lit("r"), "n": F.lit(0), "pairs": F.lit(1)})
    assert found(alignment.alignment(df, common=common)) == plain_alignment(ROWS)
    assert found(alignment.alignment(df.limit(0))) == []


def test_long_groups_in_chunks(monkeypatch):
    """Groups larger than a chunk are taken by their distinct ids."""
    known = alignment.tokenizers_in(alignment.FOLDER)
    text = ("aaaaaaaaaaaaaaaaab" * 50 + " the end ") * 3
    a, b = known.a.encode_ordinary(" " + text), known.b.encode(text)
    want = alignment.align(text.encode(), a, b, known)
    monkeypatch.setattr(alignment, "CHUNK", 4)
    for x, y in zip(alignment.align(text.encode(), a, b, known), want):
        assert (x == y) if not hasattr(x, "tolist") else x.tolist() == y.tolist()
