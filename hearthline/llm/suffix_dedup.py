"""Suffix-array dedup of long repeated byte strings, by a distributed difference-cover algorithm over phrases.

A text is parted into phrases at bytes whose next GRAM bytes have the least hash among SPAN neighbours: equal strings are parted
alike, but for their edges. Phrases are the symbols of the suffix array. Suffixes that begin at places 1 and 2 modulo 3 are the
sample: their triples of phrases are sorted and named, and names are made from triples of names until all differ or a name
covers a whole string. The remaining suffixes (0 modulo 3) are merged with either half of the sample by their first symbols and
the name behind those. In each merged order adjacent prefixes are compared, which gives for every phrase the longest run of
phrases that begins elsewhere too.

A run of LENGTH bytes or more is repeated. Strings that only overlap an end of a run are held against all others with the same
inner phrases. Of neighbouring strings with the same inner phrases, those that cover the same bytes are of one class: a class
that occurs twice is repeated, and one member answers for it. The other classes are compared BLOCK neighbouring starts at a time:
if the bytes that they have in common occur once, none of them is repeated; if the bytes that they cover together occur twice,
all are. In the blocks in between, where a run ends, each string is held against the others by the hash of its bytes, so the
result is exact.

Null and empty texts have no bytes; texts below LENGTH bytes lose nothing; equal texts of LENGTH bytes or more lose everything;
an empty table gives none; repeated rows are copies of each other; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from hearthline.llm.common import SpanHasher, mix, pieces, stage, text_or_empty, utf8

LENGTH = 400
GRAM, SPAN, BLOCK = 16, 128, 16
#: Bytes of texts that are worked on at once.
PIECE = 1 << 18


def _gram_hashes(flat: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, put together from those of runs of 1, 2, 4 bytes and so on."""
    join = lambda a, b: (a[: len(b)] ^ (a[: len(b)] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    power, width, done = flat.astype(np.uint64) + np.uint64(1), 1, 0
    out = np.zeros(len(flat) + 1, np.uint64)
    while True:
        if gram & width:
            out = join(out, power[done:])
            done += width
        if done == gram:
            return mix(out)
        power = join(power, power[width:])
        width *= 2


def _soon(span: int) -> int:
    """Up to how many places on a gram comes again soon."""
    return span // 4


def _cut(flat: np.ndarray, bounds: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By place, the place of the least hash among the ``span`` grams that begin there (ties: the first), or -1 where a text has
    fewer left or all of them come again soon; all those places, the anchors; and the places of spans that only come again."""
    soon = _soon(span)
    n = len(flat) - soon - gram - span + 2
    least, found, dull = np.full(len(flat), -1), np.zeros(len(flat), bool), np.empty(0, np.int64)
    if n > 0:
        best, width = _gram_hashes(flat, gram), 1
        short, again = (best >> np.uint64(32)).astype(np.uint32), np.zeros(len(best), bool)
        for k in range(1, soon + 1):
            again[:-k] |= short[k:] == short[:-k]
        # those that come again are greater than all others; the place in the lower half tells it and settles ties
        best = (again.astype(np.uint64) << np.uint64(63)) | (short >> np.uint32(1)).astype(np.uint64) << np.uint64(32) | np.arange(len(best), dtype=np.uint64)
        while width * 2 <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if width < span:
            best = np.minimum(best[: n + soon], best[span - width :][: n + soon])
        best = best[:n]
        fits = np.arange(n) + (soon + gram + span - 1) <= np.repeat(bounds[1:], np.diff(bounds))[:n]
        all_again = best >> np.uint64(63) > 0
        dull = np.flatnonzero(fits & all_again)
        fits &= ~all_again
        least[:n][fits] = (best[fits] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        found[least[:n][fits]] = True
    return least, np.flatnonzero(found), dull


def anchors(flat: np.ndarray, gram: int, span: int) -> np.ndarray:
    """Places whose gram has the least hash in some run of ``span`` neighbouring grams (ties: the first of the run), among those
    that do not come again soon."""
    return _cut(flat, np.array([0, len(flat)]), gram, span)[1]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with the bytes of their texts, and where each text begins (one entry more than texts)."""
    for batch, texts in pieces(batches, "text", PIECE):
        yield batch, *utf8(texts)


def _owner(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, at, "right") - 1


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(counts).astype(np.int32)), values)


def _counts(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)


def _structs(lists: pa.Array, *names: str) -> list[np.ndarray]:
    """The row of each element of a column of lists of structs, and fields of the elements."""
    flat = lists.flatten()
    return [np.repeat(np.arange(len(lists)), _counts(lists)), *(flat.field(n).to_numpy(zero_copy_only=False) for n in names)]


def _nth(counts: np.ndarray) -> np.ndarray:
    """0, 1 and so on for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _phrases(docs: DataFrame, gram: int, span: int) -> DataFrame:
    """One row for each different text: its digest, how many rows have it, its phrases' hashes and anchors, and whether a span of
    it has no anchor. A phrase goes from an anchor to the end of the next one's gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, flat, bounds in _texts(batches):
            _, at, dull = _cut(flat, bounds, gram, span)
            owner = _owner(bounds, at)
            pair = np.flatnonzero(owner[1:] == owner[:-1])
            h = SpanHasher(flat)(at[pair], at[pair + 1] + gram).view(np.int64)
            many = [np.bincount(x, minlength=batch.num_rows) for x in (owner[pair], owner)]
            yield pa.RecordBatch.from_arrays([
                batch.column("digest"), _lists(pa.array(h), many[0]), _lists(pa.array((at - bounds[owner]).astype(np.int32)), many[1]),
                pa.array(np.bincount(_owner(bounds, dull), minlength=batch.num_rows) > 0),
            ], ["digest", "phrases", "places", "dull"])

    rows = docs.select("digest", "text").mapInArrow(run, "digest binary, phrases array<bigint>, places array<int>, dull boolean")
    return rows.groupBy("digest").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("phrases", "places", "dull")))


def _named(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """The rows (d, i and others) with an increasing number of each different key in sorted order. Tasks number their sorted rows
    from 0; the first and last key of each partition meet on the driver."""
    others = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, number, place = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            e = b.column("e").to_numpy()
            if len(e):
                new = np.concatenate([[last is not None and e[0] != last], e[1:] != e[:-1]])
                local = number + np.cumsum(new)
                last, number = e[-1], int(local[-1])
                columns = [pa.array(np.full(len(e), part, np.int32)), pa.array(local), pa.array(place + np.arange(len(e)))]
                place += len(e)
                yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*b.schema.names, "part", "local", "place"])

    ordered = rows.withColumn("e", F.xxhash64(*key)).orderBy(*key, "d", "i")
    schema = T.StructType([*ordered.schema, *T.StructType.fromDDL("part int, local long, place long")])
    found = stage(ordered.mapInArrow(run, schema), "suffix-names")
    ends = found.groupBy("part").agg(F.min_by("e", "place").alias("a"), F.max_by("e", "place").alias("b"), F.max("local").alias("n")).orderBy("part").collect()
    bases, total, last = [], 0, None
    for x in ends:
        bases.append((x.part, total - (last == x.a)))
        total, last = bases[-1][1] + x.n + 1, x.b
    bases = rows.sparkSession.createDataFrame(bases, "part int, base long")
    return found.join(F.broadcast(bases), "part").select(*others, (F.col("local") + F.col("base")).alias(name))


def _ranked(sample: DataFrame) -> tuple[DataFrame, int]:
    """d, i and ranks r0, r1 and so on of the sampled suffixes (d, i, number of symbols n, s0, s1, s2), which sort as the suffixes
    do and are equal where all their symbols are; and how many ranks there are.

    r0 is the name of the first triple of symbols. Where a suffix has more symbols than its names cover, the name of the triple
    of ranks here, one and two steps on is the next rank. A step covers three times as many symbols as the last.
    """
    ranks = _named(sample, ["s0", "s1", "s2"], "r0").select("d", "i", "n", "r0")
    step, levels = 3, 1
    while not (longer := ranks.filter(F.col("n") > step)).isEmpty():
        names = [f"r{k}" for k in range(levels)]
        later = lambda c, k: F.first(c).over(W.partitionBy("d").orderBy("i").rangeBetween(k * step, k * step)).alias(f"{c}_{k}")
        near = ranks.join(longer.select("d").distinct(), "d", "left_semi").select("*", *(later(c, k) for k in (1, 2) for c in names))
        keys = [*names, *(f"{c}_{k}" for k in (1, 2) for c in names)]
        more = _named(near.filter(F.col("n") > step), keys, f"r{levels}").select("d", "i", "n", *names, f"r{levels}")
        ranks = ranks.filter(F.col("n") <= step).withColumn(f"r{levels}", F.lit(None).cast("long")).unionByName(more)
        step, levels = step * 3, levels + 1
    return ranks.drop("n"), levels


def _common(flat: np.ndarray, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """How many numbers are equal from places ``a`` and ``b`` of ``flat`` on, of n_a and n_b."""
    out, most = np.zeros(len(a), np.int64), np.minimum(n_a, n_b)
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        open_ = open_[flat[a[open_] + out[open_]] == flat[b[open_] + out[open_]]]
        out[open_] += 1
        open_ = open_[out[open_] < most[open_]]
    return out


def _adjacent(ordered: DataFrame) -> DataFrame:
    """d, i and run (phrases in common with the one before or after in the same order o) of suffixes in sorted order. The first
    and last row of each partition meet on the driver, two rows a partition."""
    names = ["d", "i", "run", "part", "o", "ahead"]

    def edge(part: int, nth: int, x: tuple) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((x[1], x[2], nth, part, x[0], x[3].tolist()), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            if not b.num_rows:
                continue
            o, d, i = (b.column(c).to_numpy() for c in ("o", "d", "i"))
            n, flat = _counts(b.column("ahead")), b.column("ahead").flatten().to_numpy()
            if last is not None:  # goes before the batch's rows
                o, d, i = (np.concatenate([[x], y]) for x, y in zip(last, (o, d, i)))
                n, flat = np.concatenate([[len(last[3])], n]), np.concatenate([last[3], flat])
            else:
                yield edge(part, 0, (int(o[0]), int(d[0]), int(i[0]), flat[: n[0]]))
            at = np.cumsum(n) - n
            both = np.where(o[1:] == o[:-1], _common(flat, at[:-1], n[:-1], at[1:], n[1:]), 0)
            best = np.maximum(np.concatenate([[0], both]), np.concatenate([both, [0]]))
            hit = np.flatnonzero(best)
            empty = [pa.nulls(len(hit), k) for k in (pa.int32(), pa.int32(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(d[hit].astype(np.int64)), pa.array(i[hit].astype(np.int32)), pa.array(best[hit].astype(np.int32)), *empty], names)
            last = int(o[-1]), int(d[-1]), int(i[-1]), flat[at[-1] :]
        if last is not None:
            yield edge(part, 1, last)

    found = stage(ordered.select("o", "d", "i", "ahead").mapInArrow(run, "d long, i int, run int, part int, o int, ahead array<bigint>"), "suffix-runs")
    edges = found.filter("part IS NOT NULL").orderBy("part", "run").collect()
    more = []
    for a, b in zip(edges[1::2], edges[2::2]):
        x, y = np.array(a.ahead), np.array(b.ahead)
        n = _common(np.concatenate([x, y]), np.array([0]), np.array([len(x)]), np.array([len(x)]), np.array([len(y)]))[0]
        if n and a.o == b.o:
            more += [(a.d, a.i, int(n)), (b.d, b.i, int(n))]
    inner = found.filter("part IS NULL").select("d", "i", "run")
    return inner.unionByName(found.sparkSession.createDataFrame(more, "d long, i int, run int")) if more else inner


def longest_runs(parted: DataFrame, length: int) -> DataFrame:
    """d, i and run: how many phrases from place i of text d also follow each other elsewhere (up to ``length`` bytes; the
    greatest counts), by the difference-cover algorithm. Phrases that occur once part the texts."""
    once = parted.select("d", F.posexplode("phrases").alias("i", "h"))
    often = once.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    kept = once.join(often, "h", "left_semi").groupBy("d").agg(F.collect_list("i").alias("kept"))
    symbols = stage(parted.select("d", "phrases", "places").join(kept, "d"), "symbols")
    ranks, levels = _ranked(_sample(symbols, length))
    listed = ranks.groupBy("d").agg(F.collect_list(F.struct("i", *(f"r{k}" for k in range(levels)))).alias("ranks"))
    # three orders, in each of which two of the three classes of suffixes are merged
    orders = stage(_orders(symbols.join(listed, "d", "left"), length, levels), "suffixes")
    return _adjacent(orders.orderBy("o", "k0", "k1", *(f"r{k}" for k in range(levels)), "d", "i"))


def _starts(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """Of texts (phrases, their places, and which are kept), with a slot for each anchor: where each text's slots begin, the
    phrases by slot, the slots of kept ones, and how many phrases each has up to ``length`` bytes or the next gap."""
    places, kept = b.column("places"), b.column("kept")
    many = _counts(places)
    begin = _offsets(many)
    values = np.zeros(int(begin[-1]), np.int64)
    real = np.zeros(len(values), bool)
    inner = np.ones(len(values), bool)
    inner[begin[1:] - 1] = False  # the last anchor of a text begins no phrase
    values[inner] = b.column("phrases").flatten().to_numpy()
    real[np.repeat(begin[:-1], _counts(kept)) + kept.flatten().to_numpy()] = True
    place = places.flatten().to_numpy().astype(np.int64)
    # places of later texts lie beyond those of earlier ones
    place = place + np.repeat(np.arange(len(many)) * (int(place.max()) + length + 1), many)
    i, gap = np.flatnonzero(real), np.flatnonzero(~real)
    stop = np.minimum(gap[np.searchsorted(gap, i)], np.searchsorted(place, place[i] + length) + 1)
    return begin, values, i, np.maximum(stop, i + 1) - i


def _ahead(values: np.ndarray, at: np.ndarray, sizes: np.ndarray, n: int) -> pa.Array:
    return pa.array(values[np.minimum(at + n, len(values) - 1)], mask=sizes <= n)


def _sample(texts: DataFrame, length: int) -> DataFrame:
    """d, i, number of symbols and the first three of them, of each suffix of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                begin, values, at, n = _starts(b, length)
                row = _owner(begin, at)
                sampled = (at - begin[row]) % 3 > 0
                at, n, row = at[sampled], n[sampled], row[sampled]
                columns = [pa.array(b.column("d").to_numpy()[row]), pa.array((at - begin[row]).astype(np.int32)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, *(_ahead(values, at, n, k) for k in range(3))], ["d", "i", "n", "s0", "s1", "s2"])

    return stage(texts.mapInArrow(run, "d long, i int, n int, s0 long, s1 long, s2 long"), "suffix-sample")


def _orders(texts: DataFrame, length: int, levels: int) -> DataFrame:
    """Every suffix in each of the three orders (o) that its class belongs to: in order o by its first o symbols (k0, k1), then by
    the ranks of the sampled suffix behind those; and its symbols up to ``length`` bytes or the next gap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            begin, values, at, n = _starts(b, length)
            row = _owner(begin, at)
            i, d = at - begin[row], b.column("d").to_numpy()
            owner, place, *ranks = _structs(b.column("ranks"), "i", *(f"r{k}" for k in range(levels)))
            spot = np.full(len(values) + 2, -1)
            spot[begin[owner] + place] = np.arange(len(place))
            columns = b.column("ranks").flatten()
            for o in range(3):
                mine = np.flatnonzero((i + o) % 3 > 0) if o == 0 else np.flatnonzero(i % 3 < 2) if o == 1 else np.flatnonzero(i % 3 != 1)
                x, many = at[mine], n[mine]
                # the rank behind counts only where the symbols go on to it
                there = np.where(many > o, spot[x + o], -1)
                take = pa.array(there, mask=there < 0)
                first = [_ahead(values, x, many, k) if k < o else pa.nulls(len(x), pa.int64()) for k in range(2)]
                ahead = _lists(pa.array(values[np.repeat(x, many) + _nth(many)]), many)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(x), o, np.int32)), *first, *(columns.field(f"r{k}").take(take) for k in range(levels)), pa.array(d[row[mine]]), pa.array(i[mine].astype(np.int32)), ahead,
                ], names)

    ranks = [f"r{k}" for k in range(levels)]
    names = ["o", "k0", "k1", *ranks, "d", "i", "ahead"]
    return texts.mapInArrow(run, f"o int, k0 long, k1 long, {', '.join(f'{r} long' for r in ranks)}, d long, i int, ahead array<bigint>")


def _runs_of(b: pa.RecordBatch, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """By anchor of a piece of texts, the longest run of phrases found there."""
    row, i, found = _structs(b.column("runs"), "i", "run")
    run = np.zeros(len(at), np.int64)
    np.maximum.at(run, np.searchsorted(at, bounds[:-1])[row] + i, found)
    return run


def _sure(at: np.ndarray, run: np.ndarray, starts: np.ndarray, length: int, gram: int) -> np.ndarray:
    """By start, whether a run of phrases that occurs elsewhere covers the string of ``length`` bytes."""
    if not len(at):
        return np.zeros(len(starts), bool)
    reach = np.where(run > 0, at[np.minimum(np.arange(len(at)) + run, len(at) - 1)] + gram, 0)
    best = np.concatenate([[0], np.maximum.accumulate(reach)])
    # runs of earlier texts end before this one's strings
    return best[np.searchsorted(at, starts, "right")] >= starts + length


def _stretches(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of equal values."""
    change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in columns])) + 1
    return np.concatenate([[0], change]), np.concatenate([change, [len(columns[0])]]) - 1


def _groups(flat: np.ndarray, bounds: np.ndarray, batch: pa.RecordBatch, length: int, gram: int, span: int) -> tuple[np.ndarray, ...]:
    """For a piece of texts: row, first and last start of each stretch of repeated strings (no more is known of those), and of
    each group of strings of ``length`` bytes with the same inner phrases, if those occur elsewhere; where a group's inside
    begins (-1 for a stretch); the hash of the inside; the hash of all bytes that the group covers, and of where its inside lies
    in them; and whether some string of the group is not known to be repeated. A string without an anchor is a group of its own."""
    least, at, _ = _cut(flat, bounds, gram, span)
    starts = np.flatnonzero(np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(flat)) >= length)
    none = np.empty(0, np.int64)
    if not len(starts):
        return none, none, none, none, none, none, none.astype(bool)
    run, row, hashes = _runs_of(batch, bounds, at), _owner(bounds, starts), SpanHasher(flat)
    sure = _sure(at, run, starts, length, gram)
    # the spans of each string that have an anchor: from the first to the last of them
    good = least >= 0
    ends, upto = np.append(np.flatnonzero(good), -1), np.cumsum(good)
    low, top = upto[starts] - good[starts], upto[starts + (length - _soon(span) - gram - span + 1)] - 1
    alone = np.flatnonzero(low > top)
    h = hashes(starts[alone], starts[alone] + length)
    _, one, which, many = np.unique(mix(h ^ mix(row[alone].astype(np.uint64))), return_index=True, return_inverse=True, return_counts=True)
    sure[alone[many[which] > 1]] = True
    a, b = _stretches(row, sure)
    a, b = a[sure[a]], b[sure[a]]
    stretches = row[a], starts[a], starts[b], np.full(len(a), -1), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.zeros(len(a), bool)
    alone, h = alone[one], h[one].view(np.int64)
    singles = row[alone], starts[alone], starts[alone], starts[alone], h, h, ~sure[alone]
    # the anchors that lie inside for certain: of the first of those spans and of the last
    number = np.zeros(len(flat) + 1, np.int64)
    number[at] = np.arange(len(at))
    first, last = number[least[ends[low]]], number[least[ends[top]]]
    first[low > top] = -1
    lo, hi = _stretches(row, first, last)
    lo, hi = lo[first[lo] >= 0], hi[first[lo] >= 0]
    ok = run[first[lo]] >= last[lo] - first[lo]
    lo, hi = lo[ok], hi[ok]
    covered = np.concatenate([[0], np.cumsum(sure)])
    place = at[first[lo]]
    inside = hashes(place, at[last[lo]] + gram)
    whole = mix(hashes(starts[lo], starts[hi] + length) + mix((place - starts[lo]).astype(np.uint64)))
    groups = row[lo], starts[lo], starts[hi], place, inside.view(np.int64), whole.view(np.int64), covered[hi + 1] - covered[lo] < hi + 1 - lo
    return tuple(np.concatenate(x) for x in zip(stretches, singles, groups))


def _blocks(hashes: SpanHasher, lo: np.ndarray, hi: np.ndarray, inside: np.ndarray, length: int, block: int) -> tuple[np.ndarray, ...]:
    """The groups' starts in blocks that stand alike before their insides: first and last start, the hash of the bytes that all
    strings of a whole block have in common, the hash of those that they cover together, whether the block is whole, and how many
    blocks each group has."""
    low, top = (lo - inside) // block, (hi - inside) // block
    many = top - low + 1
    begin = np.repeat(inside, many) + (np.repeat(low, many) + _nth(many)) * block
    first, last = np.maximum(begin, np.repeat(lo, many)), np.minimum(begin + block - 1, np.repeat(hi, many))
    whole = (first == begin) & (last == begin + block - 1)
    return first, last, hashes(begin + block - 1, begin + length).view(np.int64), hashes(first, last + length).view(np.int64), whole, many


def _twice(keys: DataFrame, name: str) -> DataFrame:
    """The values of a column that occur more than once."""
    return keys.groupBy(name).agg(F.count("*").alias("n")).filter("n > 1").select(name)


def _open_hits(texts: DataFrame, spots: DataFrame, length: int, block: int) -> DataFrame:
    """d, lo and hi: spans of starts of repeated strings, among ``spots`` (d, lo, hi, place of the inside, open) of ``texts``
    (d, text). Only open spots are asked for; the others answer them."""

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, flat, bounds in _texts(batches):
            row, lo, hi, place, asked = _structs(batch.column("spots"), "lo", "hi", "place", "open")
            at = bounds[row]
            first, last, core, hull, whole, many = _blocks(SpanHasher(flat), at + lo, at + hi, at + place, length, block)
            row, asked = np.repeat(row, many), np.repeat(asked, many)
            columns = [pa.array((x - bounds[row]).astype(np.int32)) for x in (first, last)]
            columns += [pa.array(core), pa.array(hull, mask=~whole), pa.array(asked.astype(bool))]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("d").to_numpy()[row]), *columns], ["d", "lo", "hi", "core", "hull", "open"])

    def strings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, flat, bounds in _texts(batches):
            row, lo, hi = _structs(batch.column("spots"), "lo", "hi")
            many = (hi - lo + 1).astype(np.int64)
            row, at = np.repeat(row, many), np.repeat(lo, many) + _nth(many)
            h = SpanHasher(flat)(bounds[row] + at, bounds[row] + at + length).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("d").to_numpy()[row]), pa.array(at.astype(np.int32)), pa.array(h)], ["d", "start", "h"])

    listed = spots.groupBy("d").agg(F.collect_list(F.struct("lo", "hi", "place", "open")).alias("spots"))
    blocks = texts.join(listed, "d").select("d", "text", "spots").mapInArrow(blocks_of, "d long, lo int, hi int, core long, hull long, open boolean")
    blocks = stage(blocks, "string-blocks")
    covered = _twice(blocks.filter("hull IS NOT NULL"), "hull").withColumn("all", F.lit(True))
    shared = stage(blocks.join(_twice(blocks, "core"), "core", "left_semi").join(covered, "hull", "left").withColumn("all", F.coalesce("all", F.lit(False))), "string-blocks")
    mixed = shared.filter("open AND NOT all")
    # what can equal a string of a mixed block stands in a block with the same common bytes; of equal blocks one is enough
    others = shared.filter("all OR NOT open").join(mixed.select("core").distinct(), "core", "left_semi").select("d", "lo", "hi", "hull")
    one = others.filter("hull IS NOT NULL").groupBy("hull").agg(F.min_by(F.struct("d", "lo", "hi"), F.struct("d", "lo")).alias("s")).select("s.*")
    tested = mixed.select("d", "lo", "hi").unionByName(one).unionByName(others.filter("hull IS NULL").drop("hull"))
    listed = tested.groupBy("d").agg(F.collect_list(F.struct("lo", "hi")).alias("spots"))
    strings = stage(texts.join(listed, "d").select("d", "text", "spots").mapInArrow(strings_of, "d long, start int, h long"), "strings")
    single = strings.join(_twice(strings, "h"), "h", "left_semi").select("d", F.col("start").alias("lo"), F.col("start").alias("hi"))
    return shared.filter("open AND all").select("d", "lo", "hi").unionByName(single)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that are left) of every document."""
    assert 2 * span + gram + _soon(span) <= length, "a string must hold two separate spans of grams"
    assert block < length, "the strings of a block must have bytes in common"
    keyed = docs.select("doc_id", text_or_empty().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    parted = stage(_phrases(keyed, gram, span).withColumn("d", F.monotonically_increasing_id()), "phrases")
    by_text = longest_runs(parted, length).groupBy("d").agg(F.collect_list(F.struct("i", "run")).alias("runs"))

    # the groups of strings whose inner phrases occur elsewhere; those that no run covers are open
    def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, flat, bounds in _texts(batches):
            row, lo, hi, place, inside, whole, some = _groups(flat, bounds, batch, length, gram, span)
            # a text that has a copy loses everything, so nothing is asked of it
            some &= batch.column("copies").to_numpy()[row] == 1
            known = pa.array(place < 0)
            columns = [pa.array(batch.column("d").to_numpy()[row]), *(pa.array((x - bounds[row]).astype(np.int32)) for x in (lo, hi, place)), pa.array(inside), pa.array(whole), pa.array(some), known]
            yield pa.RecordBatch.from_arrays(columns, ["d", "lo", "hi", "place", "inside", "whole", "open", "sure"])

    repeated = parted.select("d", "digest", "copies", "dull").join(by_text, "d", "left").filter("runs IS NOT NULL OR dull").drop("dull")
    texts = stage(keyed.select("digest", "text").join(repeated, "digest").dropDuplicates(["digest"]).drop("digest"), "repeated-texts")
    spots = texts.select("d", "text", "copies", "runs").mapInArrow(groups_of, "d long, lo int, hi int, place int, inside long, whole long, open boolean, sure boolean")
    spots = stage(spots, "string-groups")
    classes = spots.filter("NOT sure").groupBy("inside", "whole").agg(
        F.count("*").alias("n"), F.max("open").alias("asked"), F.min(F.struct("d", "lo", "hi", "place")).alias("s")
    )
    classes = stage(classes, "string-classes")
    # a class that occurs twice is repeated; of the others the open ones are looked at, if there are others of the same inside
    twice = spots.filter("open").join(classes.filter("n > 1 AND asked").select("inside", "whole"), ["inside", "whole"], "left_semi")
    shared = classes.groupBy("inside").agg(F.count("*").alias("k"), F.max(F.expr("asked AND n = 1")).alias("single")).filter("k > 1 AND single").select("inside")
    asked = classes.join(shared, "inside", "left_semi").select("s.*", F.expr("asked AND n = 1").alias("open"))
    hits = _open_hits(texts.select("d", "text"), asked, length, block)
    hits = hits.unionByName(spots.filter("sure").select("d", "lo", "hi")).unionByName(twice.select("d", "lo", "hi"))
    hits = hits.groupBy("d").agg(F.collect_list(F.struct("lo", "hi")).alias("spots"))
    facts = parted.select("d", "digest", "copies").join(hits, "d", "left").drop("d")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, flat, bounds in _texts(batches):
            row, lo, hi = _structs(batch.column("spots"), "lo", "hi")
            ways = np.bincount(bounds[row] + lo, minlength=len(flat) + 1) - np.bincount(bounds[row] + hi + length, minlength=len(flat) + 1)
            sizes = np.diff(bounds)
            gone = np.cumsum(ways)[:-1] > 0
            gone |= np.repeat((batch.column("copies").to_numpy() > 1) & (sizes >= length), sizes)
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            first[bounds[:-1][sizes > 0]] = gone[bounds[:-1][sizes > 0]]
            removed, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]) for x in (gone, first))
            left, ends = flat[~gone].tobytes(), _offsets(sizes - removed).tolist()
            kept = [left[a:b] for a, b in zip(ends[:-1], ends[1:])]
            columns = [pa.array(x.astype(np.int64)) for x in (sizes, removed, spans)]
            columns += [pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], out.names)

    out = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").fields])
    return keyed.join(facts, "digest").select("doc_id", "text", "copies", "spots").mapInArrow(remove, out)
