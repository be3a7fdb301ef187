"""Bounded samples of labelled documents, and the split into those to learn from and those held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, mod ``n``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % n).cast("int")


def labelled(labels: DataFrame, label: str, usable: Column, per_class: int) -> DataFrame:
    """(doc_id, y) of at most ``per_class`` documents of either label, those whose ids' digests come
    first. A document with contradicting labels counts as the larger."""
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    order = F.md5(F.col("doc_id").cast("string"))
    ones = rows.where("y = 1").orderBy(order, "doc_id").limit(per_class)
    zeros = rows.where("y <> 1").orderBy(order, "doc_id").limit(per_class)
    return ones.union(zeros)


def class_share(labels: DataFrame, label: str, usable: Column) -> float:
    """The share of label 1 among the usable labels; 0.5 without any."""
    share = labels.where(F.col(label).isNotNull() & usable).agg(F.avg((F.col(label) == 1).cast("int"))).first()[0]
    return 0.5 if share is None else share


def sampled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sample's texts: (doc_id, text, y). The sample is bounded, so it may be broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
