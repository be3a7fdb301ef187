"""Loading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# fixed values: columns of the tables the queries read; stating them saves a job that looks them up
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with ``ts`` as an instant; its zone-free values are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def zone_free(df: DataFrame) -> DataFrame:
    """Instants back to zone-free UTC values, the form the tables use."""
    times = {f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in df.columns])
