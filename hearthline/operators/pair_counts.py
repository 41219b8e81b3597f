"""Counts of the pairs that lists hold, in rounds over the items, so that no shuffle grows with the square of a list.

A list is sent once to each task that counts some of its items, packed: the gaps between its items, byte by byte, compressed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hearthline.sources.staging import stage

#: Pairs that are made at a time, for a processor's cache; a task counts some cells of them.
STEP = 1 << 18
TASK = 4
#: Pairs that a round counts: so many for each listed item, or so many cells if that is more.
ROUND, FEW = 12, 64

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def counted(lists: DataFrame, k: int, cell: int) -> DataFrame:
    """item, partner and n, the number of lists that hold both: for each item the k best partners at least. ``lists`` has size and
    items (ascending, no two equal); with ``marks``, one for each item, all pairs of two marked items are given, and for each item
    the k best of the others.

    An item's pairs are counted in one task; one with more than ``cell`` has its partners dealt to several. The
    items are dealt to so many rounds that what each shuffles is in proportion to the lists, and is freed at the round's end.
    """
    size = F.col("size").cast("long")
    shape = lists.agg(F.sum(size), F.sum(size * size), F.min(F.col("items")[0]), F.max(F.element_at("items", -1))).first()
    rows, total, low, most = (x or 0 for x in shape)
    # items with more pairs than a cell: fewer than there are cells
    often = lists.select(size.alias("size"), F.explode("items").alias("item")).groupBy("item").agg(F.sum("size").alias("pairs")).where(F.col("pairs") > cell)
    hot = {r.item: -(-r.pairs // cell) for r in stage(often, "often").collect()} if total > cell else {}
    rounds = -(-total // max(ROUND * rows, FEW * cell)) or 1
    cells = -(-total // cell) or 1
    tasks = -(-max(-(-cells // TASK), min(cells, lists.sparkSession.sparkContext.defaultParallelism)) // rounds)
    done = []
    for at in range(rounds):
        dealt = lists.drop("size").mapInArrow(_deal(at, rounds, tasks, hot, low), "task int, lists binary")
        told = dealt.repartitionById(tasks, "task").select("lists")
        done.append(stage(told.mapInArrow(_count(k, low, most - low), "item long, partner long, n long"), "pairs"))
    return reduce(DataFrame.unionByName, done)


def _deal(at: int, rounds: int, tasks: int, hot: dict[int, int], low: int) -> Batches:
    """For each task of a round the lists with an item that it counts, many to a row."""
    lowest = np.array([low], np.int64).view(np.uint64)
    names = np.array(sorted(hot), np.int64).view(np.uint64) - lowest
    parts = np.array([hot[i] for i in sorted(hot)], np.uint64)

    def own(code: np.ndarray) -> np.ndarray:
        """The task of each code, -1 in another round."""
        place = (_mixed(code) % np.uint64(rounds * tasks)).astype(np.int64)
        return np.where(place % rounds == at, place // rounds, -1)

    def sent(sizes: np.ndarray, items: np.ndarray, marks: np.ndarray | None) -> Iterator[tuple[int, bytes]]:
        starts, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        to = own(items)
        often = np.zeros(0, np.int64)
        if len(names):
            spot = np.minimum(np.searchsorted(names, items), len(names) - 1)
            often = np.flatnonzero(names[spot] == items)
            to[often] = -1
        # whole lists, each with those of its items that the task counts
        member = np.flatnonzero(to >= 0)
        code = to[member] * len(sizes) + row[member]
        order = np.argsort(code, kind="stable")
        member, (first, many) = member[order], _runs(code[order])
        which = row[member[first]]
        yield from packed(to[member[first]], many, member, sizes[which], _spans(starts[which], sizes[which]), items, marks)
        # of an item with many pairs, the partners whose pairs the task counts
        if len(often):
            long = sizes[row[often]]
            partner, of = _spans(starts[row[often]], long), np.repeat(np.arange(len(often)), long)
            to = own(_mixed(items[often])[of] + _mixed(~items[partner]) % parts[spot[often]][of])
            kept = np.flatnonzero(to >= 0)
            code = to[kept] * len(often) + of[kept]
            order = np.argsort(code, kind="stable")
            kept, (first, many) = kept[order], _runs(code[order])
            yield from packed(to[kept[first]], np.ones(len(first), np.int64), often[of[kept[first]]], many, partner[kept], items, marks)

    def packed(to, members, member, sizes, listed, items, marks) -> Iterator[tuple[int, bytes]]:
        """The lists of each task: how many items to count and which, how many are listed, the first of them and the gaps."""
        ends, of_member = np.cumsum(sizes), np.append(0, np.cumsum(members))
        starts = ends - sizes
        values = items[listed]
        gaps = np.diff(values, prepend=values[:1])
        gaps[starts] = 0
        for a, n in zip(*_runs(to)):
            b = a + n
            m, x = member[of_member[a]:of_member[b]], slice(starts[a], ends[b - 1])
            flags = [] if marks is None else [marks[m], marks[listed[x]]]
            yield to[a], _pack([members[a:b], items[m], sizes[a:b], values[starts[a:b]], gaps[x], *flags])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("items")
            sizes, items = np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy().view(np.uint64) - lowest
            marks = b.column("marks").flatten().to_numpy(zero_copy_only=False) if "marks" in b.schema.names else None
            ends = np.append(0, np.cumsum(sizes))
            for a, n in zip(*_runs((np.cumsum(sizes * sizes) - 1) // (8 * STEP))):
                x = slice(ends[a], ends[a + n])
                rows = list(sent(sizes[a:a + n], items[x], None if marks is None else marks[x]))
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())], ["task", "lists"])

    return deal


def _count(k: int, low: int, span: int) -> Batches:
    """The pairs of a task's items, counted."""
    lowest = np.array([low], np.int64).view(np.uint64)

    def told(packed: pa.Buffer) -> list[np.ndarray]:
        members, member, sizes, firsts, gaps, *marks = _unpack(packed)
        members, sizes = members.astype(np.int64), sizes.astype(np.int64)
        run = np.cumsum(gaps, dtype=np.uint64)
        items = run + np.repeat(firsts - run[np.cumsum(sizes) - sizes], sizes)
        return [members, member, sizes, items.astype(np.uint32) if span < 1 << 32 else items, *[m.astype(bool) for m in marks]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_lists = [told(x.as_buffer()) for b in batches for x in b.column("lists")]
        if not all_lists:
            return
        members, member, sizes, items, *marks = (np.concatenate(c) for c in zip(*all_lists))
        del all_lists
        starts, order = np.cumsum(sizes) - sizes, np.argsort(member, kind="stable")
        of, member = np.repeat(np.arange(len(sizes)), members)[order], member[order]
        first, many = _runs(member)
        ids, marked = member[first], marks[0][order][first] if marks else None
        ends = np.cumsum(np.add.reduceat(sizes[of], first))
        for a, n in zip(*_runs((ends - 1) // STEP)):
            lists = of[first[a]:first[a + n - 1] + many[a + n - 1]]
            item = np.repeat(np.repeat(np.arange(n), many[a:a + n]), sizes[lists])
            listed = _spans(starts[lists], sizes[lists])
            names, partner, bits = None, items[listed], span.bit_length()
            if bits + int(n).bit_length() > 61:  # ids too far apart to share an integer with the item
                names, partner = np.unique(partner, return_inverse=True)
                bits = len(names).bit_length()
            key = item << bits | partner.astype(np.int64)
            if marks:
                key = key << 1 | marks[1][listed]
            del item, listed, partner
            key.sort()
            begin, count = _runs(key)
            key = key[begin]
            flag, key = key & 1 if marks else None, key >> 1 if marks else key
            item, partner = key >> bits, key & ((1 << bits) - 1)
            partner = partner.astype(np.uint64) if names is None else names[partner]
            whole = marked[a + item] & (flag > 0) if marks else np.zeros(len(key), bool)
            other = partner != ids[a + item]
            rest = np.flatnonzero(other & ~whole)
            rest = rest[_best(item[rest], count[rest], k)]
            for kept in (rest, np.flatnonzero(other & whole)):
                for s in range(0, len(kept), 1 << 16):
                    x = kept[s:s + (1 << 16)]
                    columns = (ids[a + item[x]] + lowest).view(np.int64), (partner[x].astype(np.uint64) + lowest).view(np.int64), count[x]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "partner", "n"])

    return count


def _best(item: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """The places of each item's k largest n; items ascend, and of equal n the first places count."""
    if not len(n):
        return np.zeros(0, np.int64)
    level = np.cumsum(np.bincount(n) > 0)  # few, for counts of many different sizes are many pairs
    bits = len(n).bit_length()
    key = ((item * (int(level[-1]) + 1) + (level[-1] - level[n])) << bits) | np.arange(len(n))
    key.sort()
    begin, many = _runs(item)  # sorted, each item keeps its places
    return (key & ((1 << bits) - 1))[np.arange(len(n)) - np.repeat(begin, many) < k]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits that depend on all bits of x."""
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and how long it is."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))[:len(x)]
    return first, np.diff(first, append=len(x))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _pack(columns: Sequence[np.ndarray]) -> bytes:
    """Integers of 0 or more by their first bytes, their second bytes and so on, as far as the largest needs, compressed."""
    shape, body = [], []
    for c in columns:
        width = (int(c.max(initial=0)).bit_length() + 7) // 8
        shape += [len(c), width]
        c = c.astype(np.uint32 if width <= 4 else np.uint64)
        body += [(c >> c.dtype.type(8 * byte)).astype(np.uint8).tobytes() for byte in range(width)]
    body = b"".join(body)
    return np.array([len(body), len(columns), *shape], "<i8").tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(packed: pa.Buffer) -> list[np.ndarray]:
    length, n = np.frombuffer(packed, "<i8", 2).tolist()
    shape = np.frombuffer(packed, "<i8", 2 * n, 16).tolist()
    body = np.frombuffer(pa.decompress(packed[16 + 16 * n:], length, "zstd"), np.uint8)
    columns, at = [], 0
    for long, width in zip(shape[::2], shape[1::2]):
        c = np.zeros(long, np.uint32 if width <= 4 else np.uint64)
        for byte in range(width):
            c |= body[at:at + long].astype(c.dtype) << c.dtype.type(8 * byte)
            at += long
        columns.append(c.astype(np.uint64))
    return columns
