"""Text lines to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# fixed values: record layouts, field order as in the line
SENSOR = "id string, timestamp long, temperature double"
USER_BEHAVIOR = "user_id long, item_id long, category_id int, behavior string, timestamp long"
AD_CLICK = "user_id long, ad_id long, province string, city string, timestamp long"
MARKETING = "user_id string, behavior string, channel string, timestamp long"
LOGIN = "user_id long, ip string, event_type string, timestamp long"
ORDER = "order_id long, event_type string, transaction_id string, timestamp long"
RECEIPT = "transaction_id string, pay_channel string, event_time long"

# fixed values: access-log fields by position, and the form of its time field
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_delimited(
    df: DataFrame, schema: StructType | str, sep: str = ",", mode: str = "strict", line: str = "value"
) -> DataFrame:
    """Split ``line`` at ``sep``, trim each field and cast it.

    ``strict``  a bad number or a missing field fails the job.
    ``lenient`` bad fields are null; ``ok`` tells whether the whole line parsed, and ``raw`` keeps
                the text of lines that did not, for a quarantine table.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"unknown mode {mode!r}")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    parts = F.split(F.col(line), _literal(sep))
    split = df.withColumn("__parts", parts)

    def text(i: int) -> Column:
        # element access fails on a short line, try_element_at yields null
        return F.trim(F.col("__parts")[i] if mode == "strict" else F.try_element_at("__parts", F.lit(i + 1)))

    def typed(i: int) -> Column:
        kind = schema.fields[i].dataType
        if isinstance(kind, StringType):
            return text(i)
        return text(i).cast(kind) if mode == "strict" else text(i).try_cast(kind)

    fields = [typed(i).alias(f.name) for i, f in enumerate(schema.fields)]
    if mode == "strict":
        return split.select(*fields)
    out = split.select(*fields, F.col(line).alias("raw"))
    ok = F.lit(True)
    for f in schema.fields:
        ok = ok & F.col(f.name).isNotNull()
    return out.withColumn("ok", ok).withColumn("raw", F.when(~F.col("ok"), F.col("raw")))


def parse_access_log(df: DataFrame, line: str = "value") -> DataFrame:
    """Space-separated access log -> ip, user_id, ts, method, url."""
    split = df.withColumn("__parts", F.split(F.col(line), " "))
    field = {n: F.trim(F.col("__parts")[i]) for n, i in ACCESS_LOG_FIELDS.items()}
    return split.select(
        field["ip"].alias("ip"),
        field["user_id"].alias("user_id"),
        F.to_timestamp(field["time"], ACCESS_LOG_TIME).alias("ts"),
        field["method"].alias("method"),
        field["url"].alias("url"),
    )


def _literal(sep: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}" else c for c in sep)
