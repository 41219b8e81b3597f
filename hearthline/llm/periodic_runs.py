"""Repetitions of whole phrases in a text: every stretch of words that repeats with one period, exactly.

The words of a batch of texts become numbers. Recompression shortens the sequence level by level, first equal neighbours (block
compression: a run of k equal symbols becomes one symbol), then neighbours of a left and a right half of the alphabet (pair
compression), until each text is one symbol: a run-length grammar, of which every level's sequence is kept. As equal passages are
parsed alike but for their ends, the longest common extension of two positions is found by climbing the levels while the symbols
ahead agree, and descending to the first difference: a constant number of comparisons a level.

Candidates are points of a harmonic grid: for period q the multiples of the shortest overlap that a wanted run has, about 3 q, so
each run holds a point i with word i equal to word i + q, and all grids together have O(n log n) points. Extensions to both sides
give the run's exact ends. No suffix array is built.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import Words, pieces, text_or_empty, utf8

LEAST, EXPONENT = 6, 4
#: Bytes of text parsed together in a task.
PIECE = 1 << 20

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)
SCHEMA = [
    ("n_words", T.LongType()), ("runs", RUNS), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
    ("runs_sha256", T.StringType()), ("collapsed", T.StringType()), ("collapsed_sha256", T.StringType()),
]
Order = Callable[[pa.RecordBatch, np.ndarray], dict[int, np.ndarray]]


class Grammar:
    """The levels of a run-length grammar over numbered words; ``bounds`` has where each text begins, and the end."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.symbols: list[np.ndarray] = [words.astype(np.int64)]
        self.bounds = [bounds.astype(np.int64)]
        self.parent: list[np.ndarray] = []
        self.opens: list[np.ndarray] = []
        self.child: list[np.ndarray] = []
        self.blocks: list[bool] = []
        names, level = int(words.max(initial=0)) + 1, 0
        while np.diff(self.bounds[-1]).max(initial=0) > 1:
            names = self._rise(*self._runs(), True, names)
            if np.diff(self.bounds[-1]).max(initial=0) > 1:
                names = self._rise(*self._pairs(level), False, names)
            level += 1

    def _joined(self) -> np.ndarray:
        """Whether a symbol has a left neighbour in its text."""
        inside = np.ones(len(self.symbols[-1]) + 1, bool)
        inside[self.bounds[-1]] = False
        return inside[:-1]

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = self.symbols[-1]
        opens = np.ones(len(s), bool)
        opens[1:] = s[1:] != s[:-1]
        opens |= ~self._joined()
        first = np.flatnonzero(opens)
        return opens, s[first], np.diff(np.append(first, len(s)))

    def _pairs(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left and right half by a hash of symbol and level, turned the way that makes more pairs."""
        s = self.symbols[-1]
        salt = np.uint64((level * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        spread = (s.astype(np.uint64) + np.uint64(1)) * salt
        half = ((spread ^ (spread >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(47)) & np.uint64(1) == 0
        joined = self._joined()[1:]
        one, other = joined & half[:-1] & ~half[1:], joined & ~half[:-1] & half[1:]
        second = np.zeros(len(s), bool)
        second[1:] = one if one.sum() >= other.sum() else other
        first = np.flatnonzero(~second)
        partner = np.full(len(first), -1, np.int64)
        paired = np.append(second[1:], False)[first]
        partner[paired] = s[first[paired] + 1]
        return ~second, s[first], partner + 1

    def _rise(self, opens: np.ndarray, left: np.ndarray, right: np.ndarray, blocks: bool, names: int) -> int:
        """One level up: a group of one keeps its symbol, equal groups get one new name."""
        lone = right == (1 if blocks else 0)
        above = left.copy()
        grouped = np.flatnonzero(~lone)
        if len(grouped):
            low = int(right[grouped].max()) + 1
            _, names_of = np.unique(left[grouped] * low + right[grouped], return_inverse=True)
            above[grouped] = names + names_of
            names += int(names_of.max()) + 1
        n = len(self.symbols[-1])
        gap = np.append(np.cumsum(opens) - 1, len(above))
        self.parent.append(gap)
        self.opens.append(np.append(opens, True))
        self.child.append(np.append(np.flatnonzero(opens), n))
        self.blocks.append(blocks)
        self.symbols.append(above)
        self.bounds.append(gap[self.bounds[-1]])
        return names

    def extend(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words agree from the gaps ``a`` < ``b`` of the same text on, ahead or backwards."""
        a, b, begun = a.astype(np.int64), b.astype(np.int64), a.astype(np.int64)
        stop = np.empty(len(a), np.int64)
        live, stops = np.arange(len(a)), []
        for level in range(len(self.symbols)):
            x, y = a[live], b[live]
            same = self._same(level, x, y, doc[live], ahead)
            stops.append(live[~same])
            live, x, y = live[same], x[same], y[same]
            if not len(live):
                break
            inner = ~(self.opens[level][x] & self.opens[level][y])
            if inner.any():
                step = self._step(level, x[inner], y[inner], ahead)
                x[inner] += step
                y[inner] += step
            a[live], b[live] = x, y
            out = self.opens[level][x] & self.opens[level][y]
            stops[-1] = np.append(stops[-1], live[~out])
            live = live[out]
            a[live], b[live] = self.parent[level][x[out]], self.parent[level][y[out]]
        for level in range(len(stops) - 1, -1, -1):
            stop = np.concatenate([stop, stops[level]]) if level < len(stops) - 1 else stops[level]
            if not level or not len(stop):
                continue
            x, y = self.child[level - 1][a[stop]], self.child[level - 1][b[stop]]
            same = self._same(level - 1, x, y, doc[stop], ahead)
            if same.any():
                step = self._step(level - 1, x[same], y[same], ahead)
                x[same] += step
                y[same] += step
            a[stop], b[stop] = x, y
        return np.abs(a - begun)

    def _same(self, level: int, x: np.ndarray, y: np.ndarray, doc: np.ndarray, ahead: bool) -> np.ndarray:
        s, bounds = self.symbols[level], self.bounds[level]
        if ahead:
            inside = y < bounds[doc + 1]
            return inside & (s[np.minimum(x, len(s) - 1)] == s[np.minimum(y, len(s) - 1)])
        return (x > bounds[doc]) & (s[np.maximum(x - 1, 0)] == s[np.maximum(y - 1, 0)])

    def _step(self, level: int, x: np.ndarray, y: np.ndarray, ahead: bool) -> np.ndarray:
        """Symbols to go where those ahead agree but the groups around them may not: what is left of the shorter block, or one."""
        if not self.blocks[level]:
            return np.ones(len(x), np.int64) if ahead else -np.ones(len(x), np.int64)
        parent, child = self.parent[level], self.child[level]
        if ahead:
            return np.minimum(child[parent[x] + 1] - x, child[parent[y] + 1] - y)
        return -np.minimum(x - child[parent[x - 1]], y - child[parent[y - 1]])


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, end, period) of every maximal run of at least max(least, exponent * period) words, each with its smallest
    period, by start, then period. Positions are in ``words``; no run crosses ``bounds``."""
    n = len(words)
    longest = int(np.diff(bounds).max(initial=0))
    if longest < least:
        return np.empty((0, 3), np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grammar: Grammar | None = None
    found = np.empty((0, 3), np.int64)
    cover = np.full(n, -1, np.int64)  # a run found so far that holds the word
    first = 1
    while first <= longest // exponent:
        # periods of one octave: none is a multiple of another
        last = min(2 * first - 1, longest // exponent)
        a, q = _grid(words, doc, first, last, least, exponent)
        known = cover[a]
        inside = known >= 0
        run = found[known[inside]]
        inside[inside] = (a[inside] + q[inside] < run[:, 1]) & (q[inside] % run[:, 2] == 0)
        a, q = a[~inside], q[~inside]
        if len(a):
            grammar = grammar or Grammar(words, bounds)
            ahead, back = grammar.extend(a, a + q, doc[a], True), grammar.extend(a, a + q, doc[a], False)
            start, end = a - back, a + q + ahead
            long = end - start >= np.maximum(least, exponent * q)
            new = np.unique(np.stack([start, end, q], 1)[long], axis=0)
            if len(new):
                # a multiple of the smallest period gives the same ends
                both = np.concatenate([found, new])
                both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
                keep = np.ones(len(both), bool)
                keep[1:] = (both[1:, :2] != both[:-1, :2]).any(1)
                found = both[keep]
                cover = _cover(found, n)
        first = last + 1
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _grid(words: np.ndarray, doc: np.ndarray, first: int, last: int, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid points of all periods from ``first`` to ``last`` whose word comes again a period later in the same text."""
    n, out = len(words), []
    periods = np.arange(first, last + 1, dtype=np.int64)
    spacing = np.maximum(least, exponent * periods) - periods
    counts = np.maximum(0, (n - periods + spacing - 1) // spacing)
    at, room = 0, max(1 << 16, n // 4)
    ends = np.cumsum(counts)
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + room, "right")))
        c = counts[at:to]
        q, g = np.repeat(periods[at:to], c), np.repeat(spacing[at:to], c)
        a = (np.arange(len(q)) - np.repeat(np.cumsum(c) - c, c)) * g
        hit = words[a] == words[a + q]
        a, q = a[hit], q[hit]
        hit = doc[a] == doc[a + q]
        out.append((a[hit], q[hit]))
        at = to
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _cover(runs: np.ndarray, n: int) -> np.ndarray:
    """For each word one run that holds it, the longest of those seen together: longer ones are written last."""
    cover = np.full(n, -1, np.int64)
    for k in np.argsort(runs[:, 1] - runs[:, 0], kind="stable"):
        cover[runs[k, 0] : runs[k, 1]] = k
    return cover


def number_words(flat: np.ndarray, words: Words) -> np.ndarray:
    """Equal words get equal numbers, told apart by their bytes."""
    offsets = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    kept = np.ascontiguousarray(flat[~words.blank])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _collapsed(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words of these spans, joined by one space."""
    if not len(starts):
        return b""
    size = ends - starts + 1
    at = np.cumsum(size) - size
    take = np.arange(int(size.sum())) - np.repeat(at, size) + np.repeat(starts, size)
    out = flat[np.minimum(take, len(flat) - 1)]
    out[at + size - 1] = 32
    return out[:-1].tobytes()


def _batch(batch: pa.RecordBatch, texts: pa.Array, order: Order | None, full: bool, least: int, exponent: int) -> list[pa.Array]:
    flat, ends = utf8(texts)
    words = Words(flat, ends)
    ids = number_words(flat, words)
    bounds = words.first.astype(np.int64)
    place = np.arange(len(ids))
    for row, own in (order(batch, words.counts) if order else {}).items():
        place[bounds[row] : bounds[row + 1]] = bounds[row] + own
    ids, starts, stops = ids[place], words.starts[place], words.ends[place]
    runs = find_runs(ids, bounds, least, exponent)
    cuts = np.searchsorted(runs[:, 0], bounds)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    best: list[list[int | None]] = []
    digests, listed, collapsed, shas = [], [], [], []
    for row in range(len(bounds) - 1):
        own = runs[cuts[row] : cuts[row + 1]] - [bounds[row], bounds[row], 0]
        rows = [(s, e - s, q) for s, e, q in own.tolist()]
        top = max(rows, key=_Rank, default=(None, None, None))
        best.append(list(top))
        digests.append(hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in rows).encode()).hexdigest())
        span = slice(bounds[row], bounds[row + 1])
        stay = kept[span]
        left = _collapsed(flat, starts[span][stay], stops[span][stay])
        shas.append(hashlib.sha256(left).hexdigest())
        listed.append([{"start": s, "length": length, "period": q} for s, length, q in rows])
        collapsed.append(left.decode("utf-8", "replace") if full else None)
    one = lambda k: pa.array([x[k] for x in best], pa.int64())
    return [pa.array(words.counts, pa.int64()), pa.array(listed, _ARROW_RUNS), one(0), one(1), one(2), pa.array(digests), pa.array(collapsed, pa.string()), pa.array(shas)]


_ARROW_RUNS = pa.list_(pa.field("element", pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]), False))


class _Rank:
    """Orders runs by exact length / period, then smaller start, then smaller period."""

    def __init__(self, run: tuple[int, int, int]):
        self.run = run

    def __gt__(self, other: _Rank) -> bool:
        (s, n, q), (t, m, p) = self.run, other.run
        return (n * p, -s, -q) > (m * q, -t, -p)

    def __lt__(self, other: _Rank) -> bool:
        return other > self


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", order: Order | None = None, full: bool = True,
    least: int = LEAST, exponent: int = EXPONENT,
) -> DataFrame:
    """For each row: ``id_column``, ``n_words``, all ``runs`` (start, length, period, in words from 0) of at least
    max(least, exponent * period) words by start, then period, the one of highest exact exponent (``start``, ``length``,
    ``period``; ties: smallest start, then period; null where there is none), ``runs_sha256`` over lines start,length,period, and
    the text without repetitions: each run keeps its first period (``collapsed``, null unless ``full``, and its digest).

    ``order`` may give, for row numbers of a batch, the word positions to read in place of 0, 1, 2, ....

    A null text is empty and has no words. Repeated rows each get a result, ties are settled as above, an empty table gives an
    empty one. Other columns are not read, whatever their names. A text is one unit of work: memory is about 300 bytes a word of
    the longest text or of 1 MB of shorter ones together, in one task.
    """
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *[T.StructField(n, t) for n, t in SCHEMA]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", PIECE):
            out = _batch(batch, texts, order, full, least, exponent)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], names=[id_column, *[n for n, _ in SCHEMA]])

    return docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text")).mapInArrow(work, schema)
