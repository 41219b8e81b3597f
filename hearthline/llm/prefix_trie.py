"""The trie of all conversation prefixes, aggregated by ROLLUP.

Each conversation is a row (or several) of positional turn-id columns t1..tW; a turn id is a digest of role and text. ROLLUP over
the columns groups all prefixes of a block at once, and the grouping id tells a prefix's depth. Conversations longer than a block
go on in further rows, keyed by the node where the block before ended: the combined digest of all turns up to there. Nodes are
summed up a second time in the same way for what a whole subtree holds: each node's value is carried by its smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hearthline.llm.common import stage

WIDTH = 8
NODE = ("node_a", "node_b")
#: Conversation ids listed together before the lists of a node are put in order.
SPAN = 1024


def turn_numbers(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``number`` (from 1, by turn, null first, then role and text), ``role``, ``text``; null role or text is empty.
    Rows without a conv_id belong to no conversation."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role"), empty("text"))
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("number"), "role", "text")


def prefix_trie(conversations: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per distinct sequence of first turns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (code points of last texts that other members share, over the subtree) and
    ``ends_sha256`` (digest of the ids that end here, ascending, comma-joined).

    ``conversations`` has every conv_id (repeats do no harm); ``turns`` has conv_id, number (1, 2, ... without gaps), role, text.
    A conversation without turns is a member of the root alone; with no conversation there is no node. Null roles and texts must
    have been replaced before (turn_numbers does). Other columns are not read. Very long texts only meet a digest and a length.
    """
    turn = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    ids = turns.select(
        "conv_id", F.col("number").cast("int").alias("number"), F.substring(F.unhex(F.sha2(turn, 256)), 1, 16).alias("turn_id"),
        F.length("text").cast("long").alias("size"),
    )
    own = W.partitionBy("conv_id").orderBy("number").rowsBetween(W.unboundedPreceding, W.currentRow)
    for k, name in enumerate(NODE):
        ids = ids.withColumn(name, F.bit_xor(_salted(F.col("number"), F.col("turn_id"), k)).over(own))
    ids = stage(ids, "turn-ids")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).where(F.col("conv_id").isNotNull()).distinct()
    blocks = stage(_blocks(every, ids, width), "turn-columns")

    sizes = [F.min(f"size{k}").alias(f"v{k}") for k in range(width + 1)]
    counted = _rollup(blocks, width, [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *sizes])
    nodes = stage(counted.withColumn("size", _level(width, "v")).drop(*[f"v{k}" for k in range(width + 1)]), "trie-nodes")

    up = [F.col(f"parent_{x[-1]}").alias(x) for x in NODE]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    linked = nodes.join(children, [*NODE], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    value = linked.select(
        F.col("conv_id").alias("conv_id"), F.col("depth").alias("number"), ((F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    ).where("saved > 0 or leaf > 0")
    below = _subtrees(blocks, value, width)

    parents = nodes.select(*[F.col(x).alias(f"parent_{x[-1]}") for x in NODE], F.col("conv_id").alias("parent_conv_id"))
    ends = _ends(every, ids)
    out = (
        linked.join(below, [*NODE], "left").join(ends, [*NODE], "left")
        .join(parents, [f"parent_{x[-1]}" for x in NODE], "left")
    )
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _salted(number: Column, turn_id: Column, k: int) -> Column:
    """Half a digest of a turn at its position; a node is the exclusive or of its turns' digests."""
    return F.xxhash64(number.cast("int"), turn_id, F.lit(k)) if k == 0 else F.xxhash64(F.lit(k), turn_id, number.cast("int"))


def _blocks(every: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """A row per conversation and block: turn ids t1.., text sizes size1.., and the node at which the block begins."""
    place = F.pmod(F.col("number") - 1, F.lit(width)) + 1
    at = lambda c, k: F.max(F.when(place == k, F.col(c)))
    wide = ids.groupBy("conv_id", F.floor((F.col("number") - 1) / width).cast("int").alias("block")).agg(
        *[at("turn_id", k).alias(f"t{k}") for k in range(1, width + 1)], *[at("size", k).alias(f"size{k}") for k in range(1, width + 1)],
        *[F.max(F.when(place == 1, F.col(x).bitwiseXOR(_salted(F.col("number"), F.col("turn_id"), i)))).alias(x) for i, x in enumerate(NODE)],
    )
    bare = every.join(ids.where("number = 1"), "conv_id", "left_anti").withColumn("block", F.lit(0))
    rows = wide.unionByName(bare, allowMissingColumns=True).withColumn("size0", F.lit(0).cast("long"))
    return rows.withColumns({x: F.coalesce(x, F.lit(0).cast("long")) for x in NODE})


def _rollup(blocks: DataFrame, width: int, aggregates: list[Column]) -> DataFrame:
    """All prefixes of all blocks: node, parent node, ``depth`` and the aggregates, with ``level`` columns filled."""
    names = [f"t{k}" for k in range(1, width + 1)]
    start = [F.col(x).alias(f"start_{x[-1]}") for x in NODE]
    rows = blocks.select("block", *start, *names, *[c for c in blocks.columns if c not in {"block", *names, *NODE}])
    held = rows.groupingSets(
        [["block", "start_a", "start_b", *names[:k]] for k in range(width + 1)], "block", "start_a", "start_b", *names
    ).agg(F.grouping_id().alias("_set"), *aggregates)
    # the grouping id has a set bit for each column that is rolled up, the last ones first
    level = reduce(lambda a, k: F.when(F.col("_set") == (1 << (width - k)) - 1, k).otherwise(a), range(width + 1), F.lit(None).cast("int"))
    held = held.withColumn("level", level)
    last = reduce(lambda a, k: F.when(F.col("level") == k, F.col(f"t{k}").isNotNull()).otherwise(a), range(1, width + 1), F.col("block") == 0)
    held = held.where(last)
    turn = lambda k, i: _salted(F.col("block") * width + k, F.col(f"t{k}"), i)
    xor = lambda a, b: a.bitwiseXOR(b)
    zero = F.lit(0).cast("long")
    for i, x in enumerate("ab"):
        upto = lambda less: reduce(xor, [F.when(F.col("level") - less >= k, turn(k, i)).otherwise(zero) for k in range(1, width + 1)], F.col(f"start_{x}"))
        held = held.withColumns({f"node_{x}": upto(0), f"parent_{x}": F.when(F.col("block") * width + F.col("level") > 0, upto(1))})
    return held.withColumn("depth", F.col("block") * width + F.col("level")).drop("_set", "block", "start_a", "start_b", *names)


def _level(width: int, prefix: str) -> Column:
    return reduce(lambda a, k: F.when(F.col("level") == k, F.col(f"{prefix}{k}")).otherwise(a), range(width + 1), F.lit(None).cast("long"))


def _subtrees(blocks: DataFrame, value: DataFrame, width: int) -> DataFrame:
    """Sums of the values of all nodes below and at each node. A node's value stands at (smallest member, depth), so a prefix of
    depth d sums what its members carry at d and deeper."""
    block = F.when(F.col("number") == 0, 0).otherwise(F.floor((F.col("number") - 1) / width)).cast("int")
    at = F.when(F.col("number") == 0, 0).otherwise(F.pmod(F.col("number") - 1, F.lit(width)) + 1)
    sums = value.groupBy("conv_id", block.alias("block")).agg(
        *[F.sum(F.when(at >= k, F.col(v)).otherwise(0)).alias(f"{v}{k}") for v in ("saved", "leaf") for k in range(width + 1)]
    )
    carried = blocks.drop(*[f"size{k}" for k in range(width + 1)]).join(sums.withColumnRenamed("conv_id", "c"), (F.col("conv_id") == F.col("c")) & (blocks["block"] == sums["block"]), "left").drop("c", sums["block"])
    after = W.partitionBy("conv_id").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    later = {v: F.coalesce(F.sum(f"{v}0").over(after), F.lit(0)) for v in ("saved", "leaf")}
    carried = carried.withColumns({f"_{v}": x for v, x in later.items()})
    full = carried.select(
        "block", *NODE, *[f"t{k}" for k in range(1, width + 1)],
        *[(F.coalesce(f"{v}{k}", F.lit(0)) + F.col(f"_{v}")).alias(f"{v}{k}") for v in later for k in range(width + 1)],
    ).where(F.col("saved0") + F.col("leaf0") > 0)
    summed = _rollup(full, width, [F.sum(f"{v}{k}").alias(f"{v}{k}") for v in later for k in range(width + 1)])
    return summed.select(*NODE, _level(width, "saved").alias("saved_tokens"), _level(width, "leaf").alias("n_leaves"))


def _ends(every: DataFrame, ids: DataFrame) -> DataFrame:
    """Per node the digest of the ids that end there. Ids are first listed by spans; the lists of a node are hashed in order, one
    after another, so that no task holds them together."""
    last = ids.groupBy("conv_id").agg(*[F.max_by(x, "number").alias(x) for x in NODE])
    ending = every.join(last, "conv_id", "left").withColumns({x: F.coalesce(x, F.lit(0).cast("long")) for x in NODE})
    listed = ending.groupBy(*NODE, F.floor(F.col("conv_id") / SPAN).alias("span")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("listed")
    )
    ordered = listed.repartition(*NODE).sortWithinPartitions(*NODE, "span").select(*NODE, "listed")
    return ordered.mapInArrow(_digest_lists, "node_a long, node_b long, ends_sha256 string")


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, out = None, None, []
    for batch in batches:
        for a, b, listed in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            if (a, b) != key:
                if digest:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(listed.encode())
            else:
                digest.update(b"," + listed.encode())
        if out:
            yield _rows(out)
            out = []
    if digest:
        yield _rows([(*key, digest.hexdigest())])


def _rows(out: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out])],
        names=["node_a", "node_b", "ends_sha256"],
    )
