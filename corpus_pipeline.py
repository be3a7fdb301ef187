"""The training-data pipeline over ``documents``: reject bad texts, drop exact and near copies, remove
benchmark passages, and draw a mix of sources. Every stage works on all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontam, exact_dedup, mixing, near_dedup, quality
from tidegauge.llm.common import load, shared_dir
from tidegauge.llm.queries import EPOCHS, LEVELS, SEED, SHARE, WEIGHTS, with_domain
from tidegauge.llm.sampling import remainder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more."""
    model = quality.train(docs, load(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return quality.keep_good(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return near_dedup.near_dedup(docs, words=5, part=80, whole=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that mostly consist of them go."""
    return decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix, with n_tokens and epochs, how often each is read."""
    # rows of equal doc_id (or none) and levels are drawn alike
    key = ["__id", *(f"__{c}" for c in LEVELS)]
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id")
    drawn = mixing.mix(with_domain(docs), LEVELS, WEIGHTS, SHARE, EPOCHS, SEED)
    drawn = drawn.select(number, *[F.col(c).alias(f"__{c}") for c in LEVELS], "epochs").distinct()
    levels = [F.coalesce(F.col(c).cast("string"), F.lit(mixing.NONE)).alias(f"__{c}") for c in LEVELS]
    rows = with_domain(docs).select(*docs.columns, mixing.n_words().alias("n_tokens"), number, *levels)
    return rows.join(drawn, key).select(*docs.columns, "n_tokens", "epochs")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
]

# the classifier's fit cannot be expressed in SQL; the tests check the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's input."""
    docs, folder = load(spark, sf_dir, "documents"), f"{shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    return docs
