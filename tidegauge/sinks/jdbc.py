"""Upsert into a database table through a staging table and one MERGE per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidegauge.operators.aggregates import latest_per_key


def merge_sql(table: str, staging: str, keys: Sequence[str], values: Sequence[str]) -> str:
    """Standard MERGE: update rows whose key is there, insert the others."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    update = ", ".join(f"{v} = s.{v}" for v in values)
    columns = [*keys, *values]
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {update} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join('s.' + c for c in columns)})"
    )


def upsert_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    properties: dict[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Write one row per key to ``<table>_staging`` in parallel, then merge inside the database.

    The rows never pass through the driver; it only sends the MERGE statement. Use it from
    foreachBatch; a replayed batch replaces the staging table and merges to the same result.
    """
    staging = f"{table}_staging"
    newest = latest_per_key(df, keys, order, values)
    newest.repartition(connections).write.mode("overwrite").jdbc(url, staging, properties=properties or {})
    jvm = df.sparkSession._jvm
    info = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        info.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        statement = connection.createStatement()
        statement.execute(merge_sql(table, staging, keys, values))
        statement.close()
    finally:
        connection.close()
