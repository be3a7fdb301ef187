"""Compare a Spark result with DuckDB's answer: columns, types and rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


# fixed values: which DuckDB type answers which Spark type
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def assert_same(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    answer = con.sql(sql)
    want_types = {c: str(t) for c, t in zip(answer.columns, answer.types)}
    assert {c: TYPES[t] for c, t in spark_df.dtypes} == want_types
    got, want = canonical(spark_df.toPandas()), canonical(answer.df())
    assert len(got) == len(want), (len(got), len(want))
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)
    return len(got)
