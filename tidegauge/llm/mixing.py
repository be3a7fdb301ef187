"""Mixing sources to target weights by hierarchical budgeting, with DataFrame operations only.

Documents are leaves' members in a tree of levels (domain, language, source). A token budget goes down
the tree by the weights of siblings. No node gets more than its leaves can give, which is their tokens
times ``max_epochs``; what one cannot take goes to its siblings by weight, and reaches its parent's
siblings only if the whole parent is short. All of this is whole-number arithmetic on one row per leaf.

A leaf reads its documents in seeded random orders, one per epoch: whole epochs as often as its budget
holds, then the prefix of the next order that still fits. To find the prefix, a leaf's order is cut by
its leading digits into 256 pieces whose tokens are summed first; only the piece in which the budget
ends is cut again, and only its piece is ordered row by row. A leaf with a third of all rows is
spread over as many tasks as any.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import written

NONE = "(none)"  # the node of rows with null in a level
DIGITS, CUTS = 2, 2  # hexadecimal digits of a cut, number of cuts
WIDE = "decimal(38,0)"


def n_words(text: str = "text") -> Column:
    """Words of a text, separated by white space; null has none."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    blank = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.greatest(F.size(parts) - blank, F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for name, weight in weights.items():
        out = F.when(F.col(level) == name, weight).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parents: Sequence[str], level: str) -> DataFrame:
    """Deal ``given`` of each parent out to its children (level, weight, most): by weight, up to ``most``.

    Children in order of most / weight: those are full that could take more than their share of what
    the ones before them leave; the rest divide the remainder by weight (rounded down)."""
    nodes = nodes.where("weight > 0 and most > 0")
    order = Window.partitionBy(*parents).orderBy(F.col("most") / F.col("weight"), level)
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumns({"before": before.cast(WIDE), "after": after.cast(WIDE)})
    full = F.col("most").cast("decimal(19,0)") * F.col("after").cast("decimal(18,0)") <= (
        F.col("given").cast("decimal(19,0)") - F.col("before").cast("decimal(19,0)")
    ) * F.col("weight").cast("decimal(17,0)")
    nodes = nodes.withColumn("full", full)
    every = Window.partitionBy(*parents)
    rest = F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    nodes = nodes.withColumns({"rest": rest.cast("decimal(19,0)"), "open": open_})
    part = F.expr("cast(floor(rest * cast(weight as decimal(18,0)) div open) as long)")
    return nodes.withColumn("given", F.when(F.col("full"), F.col("most")).otherwise(part).cast("long"))


def budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int, max_epochs: int
) -> DataFrame:
    """``leaves`` (levels, supply) with ``given``, each leaf's tokens. Leaves that get none are left out."""
    leaves = leaves.withColumn("most", F.col("supply") * max_epochs)
    given = None
    for depth, level in enumerate(levels, 1):
        path, parents = list(levels[:depth]), list(levels[: depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("most").alias("most"))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level, {})))
        nodes = nodes.withColumn("given", F.lit(budget).cast("long")) if given is None else nodes.join(given, parents)
        given = _share(nodes, parents or [F.lit(0)], level).select(*path, "given")
    return leaves.drop("most").join(given.where("given > 0"), list(levels))


def mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    share: float,
    max_epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """The documents drawn, each once: doc_id, levels, n_tokens, epochs (how often it is read).

    ``weights`` gives whole numbers by level and name (1 where nothing is said, 0 leaves a node out);
    ``share`` of the corpus's tokens is the budget. A null level is a node of its own, "(none)". Rows
    that repeat a doc_id stand next to each other in every order and are drawn or left together. Rows
    with no tokens are drawn with whole epochs, or if they stand in the prefix.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        "doc_id",
        *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in levels],
        n_words().alias("n_tokens"),
    )
    rows = written(rows, "tokens")
    leaves = written(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("supply")), "leaves")
    total = leaves.agg(F.sum("supply")).first()[0] or 0
    dealt = budgets(leaves, levels, weights, int(total * share), max_epochs)
    dealt = dealt.withColumn("whole", F.expr("given div supply"))
    dealt = written(dealt.withColumn("room", F.col("given") - F.col("whole") * F.col("supply")), "budgets")
    rows = rows.join(dealt, list(levels))
    rows = rows.withColumn("key", F.md5(F.concat_ws(":", "id", F.lit(str(seed)), "whole")))
    taken = []
    for cut in range(1, CUTS + 1):
        pieces = rows.withColumn("piece", F.substring("key", 1, DIGITS * cut))
        # all rows at hand of a leaf agree in ``room``, the tokens left when their piece begins
        sums = pieces.groupBy(*levels, "piece").agg(F.sum("n_tokens").alias("tokens"), F.max("room").alias("room"))
        upto = F.sum("tokens").over(Window.partitionBy(*levels).orderBy("piece"))
        sums = sums.withColumn("upto", upto).withColumn("left", F.col("room") - F.col("upto") + F.col("tokens"))
        sums = sums.select(*levels, "piece", "left", (F.col("upto") <= F.col("room")).alias("inside"))
        pieces = pieces.join(sums, [*levels, "piece"])
        inside = F.col("inside").cast("long")
        split = ~F.col("inside") & (F.col("left") >= 0)
        taken.append(pieces.where(~split).withColumn("epochs", F.col("whole") + inside))
        rows = pieces.where(split).withColumn("room", F.col("left")).drop("piece", "left", "inside")
    # the few rows of the piece in which a leaf's budget ends
    upto = F.sum("n_tokens").over(Window.partitionBy(*levels).orderBy("key", "id"))
    taken.append(rows.withColumn("epochs", F.col("whole") + (upto <= F.col("room")).cast("long")))
    columns = ["doc_id", *levels, "n_tokens", "epochs"]
    out = taken[0].select(*columns)
    for more in taken[1:]:
        out = out.union(more.select(*columns))
    return out.where("epochs > 0")
