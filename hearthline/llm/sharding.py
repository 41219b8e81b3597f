"""Histogram sort: splitters found by counting exact bytes below candidate keys, then one exchange.

The key of a row is (xxhash64 of its text, xxhash64 of its id, its place in the written key table), so equal texts are
neighbours, and a group of copies that is larger than a shard can still be cut. Null texts and ids hash as their own values.
Empty tables give no rows. Every row, repeated ones included, gets a slot of its own. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import stage, text_or_empty

#: Candidates between the bounds of one splitter in one round.
PROBES = 64
#: How far a shard boundary may be from its ideal place, as a part of a shard's bytes.
TOLERANCE = 0.001
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _counts(keys: DataFrame, column: str, probes: np.ndarray) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe, counted in every partition and added up: as many result rows as probes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(probes) + 1), np.int64)
        for b in batches:
            at = np.searchsorted(probes, b.column(0).to_numpy(), "right")
            np.add.at(total[0], at, b.column(1).to_numpy())
            total[1] += np.bincount(at, minlength=len(probes) + 1)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, total[:, some])], ["bucket", "bytes", "n"])

    rows = keys.select(column, "size").mapInArrow(count, "bucket long, bytes long, n long")
    total = np.zeros((2, len(probes) + 1), np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect():
        total[:, r.bucket] = r.bytes, r.n
    below, n = np.cumsum(total, axis=1)[:, :-1].tolist()
    return below, n


class Bracket(NamedTuple):
    """Two keys around a target, with the bytes and rows below each."""

    low: int
    below: int
    rows_low: int
    high: int
    above: int
    rows_high: int

    def nearest(self, target: int) -> tuple[int, int]:
        """The nearer end, and how far it is from the target."""
        return min((abs(self.below - target), self.low), (abs(self.above - target), self.high))[::-1]

    def hidden(self, target: int, slack: int) -> bool:
        """Whether the target lies among several rows of one key, too far from either end."""
        return self.rows_high - self.rows_low > 1 and self.nearest(target)[1] > slack


def _search(keys: DataFrame, column: str, targets: list[int], slacks: list[int], whole: tuple[int, int]) -> list[Bracket]:
    """For each target a bracket with an end within its slack, or around one row, or around one key. Every round counts
    PROBES candidates in each open bracket."""
    found = [Bracket(LOW, 0, 0, HIGH, *whole)] * len(targets)
    is_open = lambda k: found[k].high - found[k].low > 1 and found[k].hidden(targets[k], slacks[k])
    while still := [k for k in range(len(targets)) if is_open(k)]:
        grid = sorted({b.low + (b.high - b.low) * j // (PROBES + 1) for b in (found[k] for k in still) for j in range(1, PROBES + 1)} - {LOW})
        sums = list(zip(grid, *_counts(keys, column, np.array(grid, np.int64))))
        for k in still:
            inside = [x for x in sums if found[k].low < x[0] < found[k].high]
            low = [(found[k].low, found[k].below, found[k].rows_low), *(x for x in inside if x[1] <= targets[k])][-1]
            high = [*(x for x in inside if x[1] > targets[k]), (found[k].high, found[k].above, found[k].rows_high)][0]
            found[k] = Bracket(*low, *high)
    return found


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, parts: int = 1) -> list[tuple[int, int, int]]:
    """Keys (h, t, u) at which the parts 1.. of all shards begin. Boundaries of shards are within the tolerance, those inside a
    shard within a twentieth of a part. Where no text hash meets that, the search goes on among the ids that share the hash
    in question, then among their places."""
    whole = tuple(keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first())
    n = shards * parts
    targets = [whole[0] * k // n for k in range(1, n)]
    slacks = [int(tolerance * whole[0] / shards) if k % parts == 0 else whole[0] // n // 20 for k in range(1, n)]
    out = []
    for target, slack, b in zip(targets, slacks, _search(keys, "h", targets, slacks, whole)):
        at = (b.nearest(target)[0], LOW, LOW)
        if b.hidden(target, slack):
            same, rest = keys.filter(F.col("h") == b.low), target - b.below
            c = _search(same, "t", [rest], [slack], (b.above - b.below, b.rows_high - b.rows_low))[0]
            at = (b.low, c.nearest(rest)[0], LOW)
            if c.hidden(rest, slack):
                one, last = same.filter(F.col("t") == c.low), rest - c.below
                d = _search(one, "u", [last], [slack], (c.above - c.below, c.rows_high - c.rows_low))[0]
                at = (b.low, c.low, d.nearest(last)[0])
        out.append(at)
    return sorted(out)


def key_table(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("h"),
        F.xxhash64(F.col("doc_id")).alias("t"),
        F.monotonically_increasing_id().alias("u"),
    )


def histogram_shards(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE, parts: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, exchanged once by shard and part of a shard.

    A boundary between shards is within ``tolerance`` of its ideal place in bytes, or at the nearest key where a single row
    is larger than that. ``parts`` cuts each shard into as many sorted runs, so no task holds a whole shard.
    """
    spark = docs.sparkSession
    keys = stage(key_table(docs), "shard-keys")
    cuts = splitters(keys, shards, tolerance, parts)
    key = F.struct("h", "t", "u")
    # a row's part is the number of splitters at or below its key
    part = F.lit(0)
    for h, t, u in cuts:
        at = F.struct(F.lit(h).cast("long").alias("h"), F.lit(t).cast("long").alias("t"), F.lit(u).cast("long").alias("u"))
        part = part + (key >= at).cast("int")
    placed = keys.withColumn("part", part)
    counts = {r.part: r.n for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for p in range(shards * parts):
        before = 0 if p % parts == 0 else before
        starts.append((p, before))
        before += counts.get(p, 0)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            p = b.column(0).to_numpy()
            slot = np.empty(len(p), np.int64)
            for one in np.unique(p):
                mine = np.flatnonzero(p == one)
                begin = seen.get(int(one), starts[int(one)][1])
                slot[mine] = begin + np.arange(len(mine))
                seen[int(one)] = begin + len(mine)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), b.column(3), pa.array((p // parts).astype(np.int32)), pa.array(slot)],
                ["doc_id", "size", "text_crc32", "shard", "slot"],
            )

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("size long, text_crc32 long, shard int, slot long").fields])
    return (
        placed.repartition(shards * parts, "part").sortWithinPartitions("part", "h", "t", "u")
        .select("part", "doc_id", "size", "text_crc32").mapInArrow(number, schema)
    )
