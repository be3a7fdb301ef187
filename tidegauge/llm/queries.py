"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    alignment,
    decontam,
    exact_dedup,
    html_main,
    mixing,
    near_dedup,
    pii,
    quality,
    simhash,
    substrings,
    toxicity,
    trie,
    warc,
)
from tidegauge.llm.common import load, shared_dir
from tidegauge.llm.sampling import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(load(spark, sf_dir, "documents")).drop("bucket")


@query
def op2_warc(spark, sf_dir):
    path = f"{shared_dir(spark)}/llm/archive-{uuid.uuid4().hex}"
    return warc.page_archive(load(spark, sf_dir, "pages"), path)


@query
def op3_decontamination(spark, sf_dir):
    docs, benchmark = load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, benchmark).drop("items")


LEVELS = ("domain", "lang", "source")
# the target mix: whole-number weights among siblings, 1 for names not listed
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}
SHARE, EPOCHS, SEED = 0.6, 2, 0


def with_domain(docs: DataFrame) -> DataFrame:
    """The tables name no domain: sources are dealt to four by a digest of their name."""
    return docs.withColumn("domain", F.concat(F.lit("d"), F.ascii(F.md5(F.coalesce("source", F.lit("")))) % 4))


@query
def op4_mixing(spark, sf_dir):
    return mixing.mix(with_domain(load(spark, sf_dir, "documents")), LEVELS, WEIGHTS, SHARE, EPOCHS, SEED)


@query
def op5_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(load(spark, sf_dir, "documents"), words=3, part=85, whole=100)


@query
def op6_personal_data(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return pii.find_personal(docs, pii.train(docs))


@query
def op7_quality(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return quality.quality_scores(docs, quality.train(docs, labels, remainder("doc_id", 3) != 1))


@query
def op8_substring_dedup(spark, sf_dir):
    out = substrings.remove_repeats(load(spark, sf_dir, "documents")).drop("kept")
    return out.withColumns({"n_kept": F.col("n_bytes") - F.col("n_removed"), "repeats": F.col("n_removed") > 0})


@query
def op9_main_text(spark, sf_dir):
    return html_main.main_text(load(spark, sf_dir, "pages"))


@query
def op10_toxicity(spark, sf_dir):
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, labels, remainder("doc_id", 5) != 0))


@query
def op11_simhash_dedup(spark, sf_dir):
    return simhash.simhash_groups(load(spark, sf_dir, "documents"), words=3, bits=2)


@query
def op12_conversation_trie(spark, sf_dir):
    return trie.conversation_trie(load(spark, sf_dir, "conversations"))


@query
def op13_token_alignment(spark, sf_dir):
    return alignment.alignment(load(spark, sf_dir, "documents"))
