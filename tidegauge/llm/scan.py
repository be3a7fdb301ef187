"""Running sums along keys whose rows need not fit into one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import written

PART, LOW, HIGH, ENDS = "__part", "__low", "__high", "__ends"


def _ranges(key: str, values: Sequence[str]):
    """Running sums inside a task's range, and a last row that tells its first and last key and the sums
    of the last."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, low, last, ends, kinds = TaskContext.get().partitionId(), None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, n = batch.column(key).to_numpy(), batch.num_rows
            start = np.maximum.accumulate(np.where(np.concatenate(([True], keys[1:] != keys[:-1])), np.arange(n), 0))
            columns = {c: batch.column(c) for c in batch.schema.names}
            carried, ends = ends, []
            for i, v in enumerate(values):
                own = batch.column(v).to_numpy()
                sums = np.cumsum(own)  # wraps at 64 bits
                sums = sums - (sums - own)[start]
                if keys[0] == last:
                    sums[start == 0] += carried[i]
                columns[v], columns[f"{v}_before"] = pa.array(sums), pa.array(sums - own)
                ends.append(int(sums[-1]))
            low, last = (int(keys[0]) if low is None else low), int(keys[-1])
            columns |= {
                PART: pa.array(np.full(n, part, np.int32)),
                LOW: pa.nulls(n, pa.int64()),
                HIGH: pa.nulls(n, pa.int64()),
                ENDS: pa.nulls(n, pa.list_(pa.int64())),
            }
            out = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            kinds = out.schema
            yield out
        if kinds is not None:
            told = {PART: part, LOW: low, HIGH: last, ENDS: ends}
            yield pa.RecordBatch.from_pylist([{name: told.get(name) for name in kinds.names}], schema=kinds)

    return scan


def _carried(found: list, values: Sequence[str]) -> dict[int, tuple[int, list[int]]]:
    """What the ranges before hold of a range's first key, by range."""
    out, key, sums = {}, None, [0] * len(values)
    for part, low, high, ends in sorted(found):
        if low == key:
            out[part] = low, sums
        if high == key:
            ends = [(a + b + (1 << 63)) % (1 << 64) - (1 << 63) for a, b in zip(sums, ends)]
        key, sums = high, ends
    return out


def running_sums(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with each long column v of ``values`` replaced by its sum over the key's rows up to and with this
    one, by ``order``, modulo 2^64, and with the sum of the rows before this one as v_before. ``key`` and ``values`` are longs without nulls; (key, order) tells rows
    apart, or ties are taken as they come.

    Rows are dealt to tasks by ranges of (key, order), so a key with a third of all rows is spread. Tasks sum
    their range; a second pass adds what the ranges before hold of a range's first key. One row of a few
    numbers per task reaches the driver.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in [*df.dtypes, *[(f"{v}_before", "long") for v in values]])
    names = [*df.columns, *[f"{v}_before" for v in values]]
    dealt = df.repartitionByRange(tasks, key, *order).sortWithinPartitions(key, *order)
    told = f"{kinds}, {PART} int, {LOW} long, {HIGH} long, {ENDS} array<long>"
    local = written(dealt.mapInArrow(_ranges(key, values), told), "ranges")
    carried = _carried([tuple(r) for r in local.where(F.col(LOW).isNotNull()).select(PART, LOW, HIGH, ENDS).collect()], values)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = batch.column(key).to_numpy(), batch.column(PART).to_numpy()
            columns = {c: batch.column(c) for c in names}
            for part in set(np.unique(parts).tolist()) & carried.keys():
                low, sums = carried[part]
                mine = (parts == part) & (keys == low)
                for v, s in zip([*values, *[f"{v}_before" for v in values]], sums * 2):
                    columns[v] = pa.array(columns[v].to_numpy() + np.where(mine, np.int64(s), np.int64(0)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return local.where(F.col(LOW).isNull()).select(*names, PART).mapInArrow(added, kinds)
