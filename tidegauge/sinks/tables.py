"""Keyed upsert tables: the stored value of a key is that of its latest row.

Layout: ``<path>/gen=<n>/part=<p>/*.parquet``. Keys are split in parts by hash, and a merge writes
the parts it touches as a new generation. ``<path>/_parts`` says how many parts there are. Spark puts
``_SUCCESS`` into a generation when all of it is written; readers take each part from its newest
generation that has one. Nothing is changed in place, so a merge that dies on the way leaves the table
as it was.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.aggregates import latest_per_key

PART = "part"
GENERATION = "gen"
DELTA = "delta"
PARTS = "_parts"
LAYOUT = "_layout"


def _glob(spark: SparkSession, pattern: str) -> tuple[list, object]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath() for status in files.globStatus(path) or []], files


def _complete(spark: SparkSession, path: str, kind: str = GENERATION) -> list[int]:
    """Numbers of the complete generations (or deltas)."""
    marks, _ = _glob(spark, f"{path}/{kind}=*/_SUCCESS")
    return sorted(int(m.getParent().getName().split("=")[1]) for m in marks)


def _following(spark: SparkSession, path: str) -> int:
    return max([*_complete(spark, path), *_complete(spark, path, DELTA)], default=-1) + 1


def _folders(spark: SparkSession, path: str, kind: str = GENERATION) -> dict[str, list[int]]:
    """Part folder name -> the complete generations (or deltas) it is in, oldest first. Names only, no data."""
    complete = set(_complete(spark, path, kind))
    found: dict[str, list[int]] = {}
    for folder in _glob(spark, f"{path}/{kind}=*/{PART}=*")[0]:
        n = int(folder.getParent().getName().split("=")[1])
        if n in complete:
            found.setdefault(folder.getName(), []).append(n)
    return {part: sorted(ns) for part, ns in found.items()}


def _live(spark: SparkSession, path: str) -> dict[str, tuple[int | None, list[int]]]:
    """Part folder name -> its newest generation, and the deltas after it."""
    bases, deltas = _folders(spark, path), _folders(spark, path, DELTA)
    found = {}
    for part in bases.keys() | deltas.keys():
        base = bases[part][-1] if part in bases else None
        found[part] = base, [n for n in deltas.get(part, []) if base is None or n > base]
    return found


def _read(spark: SparkSession, path: str, kind: str, folders: list[tuple[int, str]]) -> DataFrame:
    paths = [f"{path}/{kind}={n}/{part}" for n, part in folders]
    return spark.read.option("basePath", path).parquet(*paths).drop(kind)


def _merged(spark: SparkSession, path: str, live: dict[str, tuple[int | None, list[int]]]) -> DataFrame:
    """Rows of parts that have deltas."""
    layout = json.loads(_text(spark, f"{path}/{LAYOUT}"))
    rows = _read(spark, path, DELTA, [(n, part) for part, (_, ns) in live.items() for n in ns])
    bases = [(base, part) for part, (base, _) in live.items() if base is not None]
    if bases:
        rows = rows.unionByName(_read(spark, path, GENERATION, bases))
    keys = [*layout["keys"], PART]
    return latest_per_key(rows, keys, layout["order"], [c for c in rows.columns if c not in keys]).select(*rows.columns)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    live = _live(spark, path)
    plain = [(base, part) for part, (base, deltas) in live.items() if not deltas]
    changed = {part: found for part, found in live.items() if found[1]}
    stored = _read(spark, path, GENERATION, plain) if plain else None
    if changed:
        merged = _merged(spark, path, changed)
        stored = merged if stored is None else stored.unionByName(merged)
    return stored


def _text(spark: SparkSession, name: str, text: str | None = None) -> str | None:
    """The text of a small file, which is made of ``text`` if it is not there."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(mark):
        stream = files.open(mark)
        try:
            return stream.readUTF()
        finally:
            stream.close()
    if text is not None:
        stream = files.create(mark, False)
        try:
            stream.writeUTF(text)
        finally:
            stream.close()
    return text


def _parts(spark: SparkSession, path: str, wanted: int) -> int:
    """How many parts the table has; a new table gets ``wanted``."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTS}")
    files = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(mark):
        stream = files.open(mark)
        try:
            return stream.readInt()
        finally:
            stream.close()
    stream = files.create(mark, False)
    try:
        stream.writeInt(wanted)
    finally:
        stream.close()
    return wanted


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been stored at ``path``."""
    return bool(_complete(spark, path) or _complete(spark, path, DELTA))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    stored = _stored(spark, path)
    if stored is None:
        raise FileNotFoundError(f"no table at {path}")
    return stored.drop(PART)


def upsert_table(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], values: Sequence[str], parts: int = 64
) -> None:
    """Merge ``df`` into the table at ``path``.

    The batch shrinks to one row per key before anything is read; of the stored table only the
    parts the batch touches are read and written. The outcome depends on ``order`` alone, so
    applying a batch twice changes nothing. ``parts`` counts for a new table; one that is there keeps
    its own number. One writer at a time.
    """
    spark = df.sparkSession
    parts = _parts(spark, path, parts)
    kept = [*keys, *dict.fromkeys([*order, *values])]
    part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")
    rest = [c for c in kept if c not in keys]
    merged = fresh = latest_per_key(df.select(*kept), keys, order, rest).withColumn(PART, part)
    stored = _stored(spark, path)
    if stored is not None:
        # at most ``parts`` small integers
        touched = F.broadcast(fresh.select(PART).distinct())
        both = stored.join(touched, PART, "left_semi").select(*kept).unionByName(fresh.select(*kept))
        merged = latest_per_key(both, keys, order, rest).withColumn(PART, part)
    following = _following(spark, path)
    (
        merged.select(*kept, PART)
        .repartition(parts, PART)
        .write.mode("overwrite")
        .partitionBy(PART)
        .parquet(f"{path}/{GENERATION}={following}")
    )


def append_table(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    parts: int = 64,
    share: float = 0.5,
) -> None:
    """``upsert_table`` that reads nothing of the stored table and writes one row per key of ``df``.

    A part whose deltas weigh more than ``share`` of its generation is then merged into a new one. One writer at a
    time; a batch that is replayed changes nothing.
    """
    spark = df.sparkSession
    parts = _parts(spark, path, parts)
    kept = [*keys, *dict.fromkeys([*order, *values])]
    layout = json.dumps({"keys": list(keys), "order": list(order)})
    if _text(spark, f"{path}/{LAYOUT}", layout) != layout:
        raise ValueError(f"the table at {path} has other keys or another order")
    part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")
    fresh = latest_per_key(df.select(*kept), keys, order, [c for c in kept if c not in keys]).withColumn(PART, part)
    delta = fresh.select(*kept, PART).repartition(parts, PART).write.mode("overwrite").partitionBy(PART)
    delta.parquet(f"{path}/{DELTA}={_following(spark, path)}")
    compact(spark, path, share)


def _bytes(spark: SparkSession, path: str, kind: str) -> dict[tuple[str, int], int]:
    """(part folder name, number) -> bytes of its files."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/{PART}=*/*")
    found: dict[tuple[str, int], int] = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        folder = status.getPath().getParent()
        at = folder.getName(), int(folder.getParent().getName().split("=")[1])
        found[at] = found.get(at, 0) + status.getLen()
    return found


def compact(spark: SparkSession, path: str, share: float = 0.5) -> int:
    """Merge the parts whose deltas weigh more than ``share`` of their generation; how many that were."""
    bases, deltas = _bytes(spark, path, GENERATION), _bytes(spark, path, DELTA)
    heavy = {}
    for part, (base, ns) in _live(spark, path).items():
        changed = sum(deltas.get((part, n), 0) for n in ns)
        if ns and changed > share * (0 if base is None else bases.get((part, base), 0)):
            heavy[part] = base, ns
    if heavy:
        rows = _merged(spark, path, heavy).repartition(len(heavy), PART)
        rows.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/{GENERATION}={_following(spark, path)}")
    return len(heavy)


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete part folders superseded by ``keep`` newer ones, and deltas merged into the oldest that stays; run
    it when no older reader is left."""
    gone, oldest = [], {}
    for part, generations in _folders(spark, path).items():
        gone += [(GENERATION, n, part) for n in generations[: -keep or None]]
        if keep and generations:
            oldest[part] = generations[-keep:][0]
    for part, numbers in _folders(spark, path, DELTA).items():
        gone += [(DELTA, n, part) for n in numbers if part in oldest and n < oldest[part]]
    for kind, n, part in gone:
        folders, files = _glob(spark, f"{path}/{kind}={n}/{part}")
        for folder in folders:
            files.delete(folder, True)
