"""Session settings the library relies on, and where checkpoints live."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # transformWithState needs a state store that keeps state off the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def build_session(app_name: str = "tidegauge", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with the library's settings; ``extra`` wins over them.

    Keyword names use ``__`` for the dots of a Spark key, as in
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    On a cluster ``spark.checkpoint.dir`` is set and always wins, because executors and a
    restarted driver must see the same files. Only a local session may fall back to a folder
    of this machine; elsewhere a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="tidegauge-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local
