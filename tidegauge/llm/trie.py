"""Prefix trie of conversations through digests of fixed-length blocks.

A prefix is known by the sum of its turns' hashes, salted with their positions, in two 64-bit lanes: an
equal sum at an equal depth is an equal sequence, and sums can be run over ranges of one long
conversation in several tasks.

Conversations are grouped by the digests of successive blocks of ``block`` turns first. Where all that
share the prefix before a block share the block too, one conversation's turns stand for all of them.
Only in blocks where they diverge (or end at different turns) are all turn boundaries looked at.

Each node belongs to its smallest member, and what a conversation owns are the last nodes of its path. So
a sum over a node's subtree is the sum over its members of what they own, less what its owner owns above
it: no walk down the levels, however deep the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import written
from tidegauge.llm.scan import running_sums

BLOCK = 4
HEADS = 6  # fixed value: heads are of 0 to HEADS - 1 turns
PIECE = 1 << 16  # bytes of ids that travel in a row
NODE = ("depth", "a", "b")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, digest, points) of turns numbered from 1: by turn (null first), then role, then
    the text's MD5. Null role or text is empty; rows without conv_id belong to no conversation."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        F.length(text).cast("long").alias("points"),
        F.lit(1).cast("long").alias("pos"),
    )
    found = running_sums(rows, "conv_id", ["turn", "role", "digest"], ["pos"])
    return found.select("conv_id", "pos", "role", "digest", "points")


def head_length(conv_id: str) -> Column:
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS).cast("long")


def rebuilt(turns: DataFrame, group: int = 100) -> DataFrame:
    """``turns`` with each conversation's first h turns replaced by those of the first conversation of its
    ``group`` of ids, as far as there are any; h is 0 to 5, from the id's CRC-32."""
    heads = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    convs = turns.where("pos = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    taken = convs.join(heads, "base").where(F.col("pos") <= head_length("conv_id"))
    columns = ["conv_id", "part", "pos", "role", "digest", "points"]
    rows = taken.withColumn("part", F.lit(0)).select(columns).union(
        turns.where(F.col("pos") > head_length("conv_id")).withColumn("part", F.lit(1)).select(columns)
    )
    found = running_sums(rows.withColumn("at", F.lit(1).cast("long")), "conv_id", ["part", "pos"], ["at"])
    return found.select("conv_id", F.col("at").alias("pos"), "role", "digest", "points")


def _chained(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, points, a, b, a_before, b_before): the two lanes of the prefix with and without this turn."""
    lanes = {"a": F.xxhash64("pos", "role", "digest"), "b": F.xxhash64("digest", "pos", "role")}
    rows = turns.withColumns(lanes).select("conv_id", "pos", "points", "a", "b")
    return running_sums(rows, "conv_id", ["pos"], ["a", "b"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (node, conv_id): the node's ids as comma-joined text, in pieces."""
    node, first, ids, size = None, None, [], 0

    def out() -> pa.RecordBatch:
        row = {**dict(zip(NODE, node)), "first": first, "ids": ",".join(ids)}
        return pa.RecordBatch.from_pylist([row], schema=kinds)

    kinds = pa.schema([*[(c, pa.int64()) for c in (*NODE, "first")], ("ids", pa.string())])
    for batch in batches:
        for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if at != node or size > PIECE:
                if node is not None:
                    yield out()
                node, first, ids, size = at, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if node is not None:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (node, first): the SHA-256 of each node's joined ids."""
    kinds = pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())])
    node, state = None, None

    def row() -> dict:
        return {**dict(zip(NODE, node)), "ends_sha256": state.hexdigest()}

    for batch in batches:
        rows = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if at != node:
                if node is not None:
                    rows.append(row())
                node, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
    if node is not None:
        yield pa.RecordBatch.from_pylist([row()], schema=kinds)


def _ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of nodes where conversations end; ``ends``: those and conv_id. A node where
    a third of all end is sorted and joined to text by ranges; one task only hashes the pieces."""
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    node = ", ".join(f"{c} long" for c in NODE)
    rows = ends.repartitionByRange(tasks, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = rows.select(*NODE, "conv_id").mapInArrow(_pieces, f"{node}, first long, ids string")
    pieces = pieces.repartition(tasks, *NODE).sortWithinPartitions(*NODE, "first")
    return pieces.mapInArrow(_hashed, f"{node}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of ``turns`` (conv_id, pos from 1 without gaps, role, digest, points); ``convs`` (conv_id) lists
    all conversations, also those without turns, each once.

    One row per distinct prefix: conv_id (smallest member), depth, parent_conv_id (null for the root, which is
    there unless there are no conversations), n_convs, n_children, n_leaves and saved_tokens over its subtree,
    ends_sha256 of the ids of the conversations that end there.
    """
    chain = written(_chained(turns), "chain")
    last = F.max_by(F.struct("a", "b"), "pos").alias("end")
    ended = chain.groupBy("conv_id").agg(F.max("pos").alias("depth"), last)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    ended = convs.join(ended, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(n) for n, c in zip(NODE, ("depth", "end.a", "end.b"))]
    )

    # one row per conversation and block: the prefix before it, the one after it, the turns inside
    number = F.floor((F.col("pos") - 1) / block).cast("long").alias("block")
    turn = F.struct("pos", "points", *NODE[1:], "a_before", "b_before")
    blocks = chain.groupBy("conv_id", number).agg(F.array_sort(F.collect_list(turn)).alias("inside"))
    head, tail = F.col("inside")[0], F.element_at("inside", -1)
    key = ["block", "from_a", "from_b"]
    blocks = blocks.select(
        "conv_id", "block", head["a_before"].alias("from_a"), head["b_before"].alias("from_b"),
        F.struct(tail["pos"].alias("pos"), tail["a"].alias("a"), tail["b"].alias("b")).alias("to"), "inside",
    )
    blocks = written(blocks, "blocks")
    groups = blocks.groupBy(*key).agg(
        F.count("*").alias("n_convs"),
        F.min(F.struct("conv_id", "inside")).alias("one"),
        (F.min("to") == F.max("to")).alias("same"),
    )
    groups = written(groups, "block_groups")
    node = [F.col("t.pos").alias("depth"), *[F.col(f"t.{c}").alias(c) for c in ("a", "b", "a_before", "b_before", "points")]]
    together = groups.where("same").select(*key, "n_convs", F.col("one.conv_id").alias("conv_id"), F.explode("one.inside").alias("t"))
    together = together.select(*key, *node, "n_convs", "conv_id")
    apart = blocks.join(groups.where("not same").select(*key), key, "left_semi")
    apart = written(apart.select("conv_id", F.explode("inside").alias("t")).select("conv_id", *node), "apart")
    split = apart.groupBy(*NODE, "a_before", "b_before").agg(
        F.max("points").alias("points"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    root = convs.groupBy(*[zero.alias(c) for c in (*NODE, "points")])
    root = root.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = together.unionByName(split, True).unionByName(root, True)

    up = [F.col("depth") - 1, F.col("a_before"), F.col("b_before")]
    above = [c.alias(n) for c, n in zip(up, NODE)]
    nodes = written(nodes, "nodes")
    kids = nodes.where("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("points")
    nodes = nodes.join(kids, list(NODE), "left").withColumns({"n_children": F.coalesce("n_children", zero), "saved": saved})
    # saved_before: what the owner saves above the node
    nodes = written(running_sums(nodes.withColumn("own", F.col("saved")), "conv_id", ["depth"], ["saved"]), "owned")
    owned = nodes.groupBy("conv_id").agg(
        F.sum("own").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")
    )
    sums = [F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves")]
    owned = written(owned, "owners")
    of_groups = blocks.select("conv_id", *key).join(owned, "conv_id").groupBy(*key).agg(*sums)
    of_split = apart.select("conv_id", *NODE).join(owned, "conv_id").groupBy(*NODE).agg(*sums)
    of_root = owned.groupBy(*[zero.alias(c) for c in NODE]).agg(*sums)
    whole, rest = nodes.where("from_a is not null"), nodes.where("from_a is null")
    summed = whole.join(of_groups, key).unionByName(rest.join(of_split.unionByName(of_root), list(NODE)))

    # a node's parent has another owner only where a conversation's own nodes begin
    names = nodes.select(F.col("conv_id").alias("parent_conv_id"), *[F.col(c).alias(f"p_{c}") for c in NODE])
    tops = nodes.groupBy("conv_id").agg(F.min_by(F.struct(*above), "depth").alias("up"), F.min("depth").alias("top"))
    tops = tops.join(names, [F.col(f"up.{c}") == F.col(f"p_{c}") for c in NODE], "left").select("conv_id", "top", "parent_conv_id")
    out = summed.join(_ends(ended), list(NODE), "left").join(tops, "conv_id")
    return out.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("all_saved") - F.col("saved_before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, group: int = 100, block: int = BLOCK) -> DataFrame:
    """``prefix_trie`` of ``conversations`` (conv_id, turn, role, text) rebuilt with shared heads. Repeated rows
    are turns of their own; other columns are ignored; an empty table gives no rows."""
    turns = written(numbered(conversations), "turns")
    return prefix_trie(rebuilt(turns, group), turns.where("pos = 1").select("conv_id"), block)
