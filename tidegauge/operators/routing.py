"""Filters, multi-way routing, side outputs and unions. All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: requests for these are not page visits
STATIC_SUFFIXES = (".css", ".ico", ".png")


def drop_static_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """Keep page visits. One pattern names the column once: a filter pushed below the parsing of a
    line evaluates that parsing again for every mention of the column."""
    suffixes = "|".join(s.replace(".", "[.]") for s in STATIC_SUFFIXES)
    return df.where(~F.col(url).rlike(f"({suffixes})$|^/$"))


def drop_empty(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have all of ``columns``: neither null nor an empty text. Before a join on ids it keeps
    the rows without one from meeting under one hot key."""
    for name in columns:
        df = df.where(F.col(name) != "")
    return df


def route(df: DataFrame, branches: Mapping[str, Column], name: str = "routes") -> DataFrame:
    """Add the array of tags whose condition holds; a row may take several routes."""
    tags = F.array(*[F.when(cond, F.lit(tag)) for tag, cond in branches.items()])
    return df.withColumn(name, F.array_compact(tags))


def select_routes(df: DataFrame, *tags: str, name: str = "routes") -> DataFrame:
    """Rows on any of ``tags``, each once."""
    return df.where(F.arrays_overlap(F.col(name), F.array(*[F.lit(t) for t in tags]))).drop(name)


def side_output(df: DataFrame, condition: Column, alert: Column, name: str = "alert") -> DataFrame:
    """Tag rows ``side`` with an alert text, or ``main``; one scan feeds both branches."""
    return df.withColumn("route", F.when(condition, "side").otherwise("main")).withColumn(
        name, F.when(condition, alert)
    )


def co_map(
    a: DataFrame, b: DataFrame, fa: Callable[[DataFrame], DataFrame], fb: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Map two inputs of different shape into one output; columns one lacks are null."""
    return fa(a).unionByName(fb(b), allowMissingColumns=True)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def map_partitions(
    df: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: str,
    open_: Callable[[], object] | None = None,
    close: Callable[[], None] | None = None,
) -> DataFrame:
    """Map Arrow batches with set-up before a task's first batch and clean-up after its last. What
    ``open_`` returns, if anything, is handed to ``fn`` with each batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = open_() if open_ else None
        try:
            for batch in batches:
                yield fn(batch) if held is None else fn(batch, held)
        finally:
            if close:
                close()

    return df.mapInPandas(run, schema)
