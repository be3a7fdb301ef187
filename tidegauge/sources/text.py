"""Lines and delimited files, in batch or as file streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """Text, one row per line, column ``value``."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Delimited file with a given schema; blanks around fields are ignored, a bad field fails."""
    reader = (spark.readStream if streaming else spark.read).schema(schema).options(
        sep=sep, mode="FAILFAST", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def from_elements(spark: SparkSession, *elements: object) -> DataFrame:
    """Elements of mixed types as text, with the type each had."""
    return spark.createDataFrame([(str(e), type(e).__name__) for e in elements], "value string, kind string")
