"""Benchmark decontamination: n-gram seeds join training passages to test items, Smith-Waterman alignment scores them.

Words are lower-cased (A-Z). Every n-gram of an item is a seed, whatever its frequency, and one seed is enough: the seeds of
an item that lie near one diagonal of a document give a window, each window that has enough words of its item is aligned with
it, and of alignments that overlap the best counts. So a copy is found as long as GRAM neighbouring words of it are intact.

Null and blank texts hold no passage. Items shorter than the n-gram are one seed of all their words; items without words
match nothing. A row is one passage: a document that holds an item twice gives two rows, repeated rows give repeated results,
an empty table gives none, other columns of the documents are carried in ``keep``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import Words, lowered, mix, pieces, small_enough, stage, utf8

GRAM = 3
#: Item n-grams up to which they travel with the tasks (16 bytes each); beyond, words are joined by hash.
MOST_GRAMS = 200_000
#: Alignment: points for equal words, for different words, and for a word without partner.
MATCH, OTHER, GAP = 2, -1, -1
#: Least points of a passage, as a part of what the whole item would have.
SCORE = 0.5
#: Least number of equal words.
EQUAL_WORDS = 6


def gram_hashes(words: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Hash of the n words that begin at each place where n follow."""
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        out = mix(out + words[k : k + len(out)])
    return out


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    flat, bounds = utf8(texts)
    words = Words(lowered(flat), bounds)
    return words, words.hashes()


def item_grams(items: DataFrame, key: str = "item_id") -> DataFrame:
    """item, place and gram of each n-gram of each item, with the item's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            words, hashes = _tokens(texts)
            for k, item in enumerate(batch.column("item").to_pylist()):
                mine = hashes[words.first[k] : words.first[k + 1]]
                if len(mine):
                    grams = gram_hashes(mine, min(GRAM, len(mine)))
                    yield pa.RecordBatch.from_pydict({
                        "item": [item] * len(grams), "place": np.arange(len(grams), dtype=np.int32), "gram": _signed(grams), "size": np.full(len(grams), len(mine), np.int32),
                    })

    rows = items.select(F.col(key).alias("item"), F.col("text").cast("string").alias("text")).filter("item IS NOT NULL")
    schema = T.StructType([T.StructField("item", items.schema[key].dataType), *T.StructType.fromDDL("place int, gram long, size int").fields])
    return rows.mapInArrow(run, schema)


def _windows(hits: list[tuple], most: int) -> list[tuple]:
    """(item, [(first word, word after the last)]) of the clusters of hits (item, size, document word, item word) of a document."""
    by_item: dict = defaultdict(list)
    for item, size, at, place in hits:
        by_item[item].append((at - place, size))
    out = []
    for item, found in by_item.items():
        found.sort()
        size = found[0][1]
        slack = max(4, size // 4)
        breaks = [k for k in range(1, len(found)) if found[k][0] - found[k - 1][0] > slack]
        groups = [(found[a][0], found[b - 1][0]) for a, b in zip([0, *breaks], [*breaks, len(found)])]
        out.append((item, [(max(0, a - slack), min(most, b + size + slack)) for a, b in groups]))
    return out


def passages(docs: DataFrame, seed_rows: DataFrame, keep: list[str], seed_list: list | None, short: list[int]) -> DataFrame:
    """The kept columns with item, and first word and words of each passage that may hold it."""
    item_type = seed_rows.schema["item"].dataType
    kept = [docs.schema[c] for c in keep]
    out = T.StructType([*kept, T.StructField("item", item_type), *T.StructType.fromDDL("first_words array<int>, passages array<array<string>>").fields])
    types = (None, pa.list_(pa.int32()), pa.list_(pa.list_(pa.string())))

    def cut(words: Words, data: bytes, k: int, low: int, high: int) -> list[str]:
        a = words.first[k]
        return [data[s:e].decode() for s, e in zip(words.starts[a + low : a + high].tolist(), words.ends[a + low : a + high].tolist())]

    def row(words: Words, data: bytes, k: int, item: object, spans: list[tuple]) -> tuple:
        return k, item, [low for low, _ in spans], [cut(words, data, k, *span) for span in spans]

    if seed_list is not None:
        grams = np.array([r.gram for r in seed_list], np.int64).view(np.uint64)
        order = np.argsort(grams, kind="stable")
        sorted_grams, info = grams[order], [(seed_list[i].item, seed_list[i].size, seed_list[i].place) for i in order]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in pieces(batches, "text", 1 << 20):
                words, hashes = _tokens(texts)
                doc = words.doc()
                hits: dict[int, list] = defaultdict(list)
                for n in short:
                    g = gram_hashes(hashes, n)
                    low = np.searchsorted(sorted_grams, g)
                    for at in np.flatnonzero(sorted_grams[np.minimum(low, len(sorted_grams) - 1)] == g).tolist() if len(sorted_grams) else ():
                        if doc[at] != doc[at + n - 1]:
                            continue
                        k, i = int(doc[at]), int(low[at])
                        while i < len(sorted_grams) and sorted_grams[i] == g[at]:
                            item, size, place = info[i]
                            if min(size, GRAM) == n:
                                hits[k].append((item, size, at - int(words.first[k]), place))
                            i += 1
                rows = []
                data = words.flat.tobytes() if hits else b""
                for k, found in hits.items():
                    rows += [row(words, data, k, *window) for window in _windows(found, int(words.counts[k]))]
                if rows:
                    taken = batch.take(pa.array([r[0] for r in rows]))
                    columns = [pa.array(c, t) for c, t in zip(list(zip(*rows))[1:], types)]
                    yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in keep), *columns], out.names)

        return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, out)

    # too many items for a task: the documents' n-grams are exchanged by hash, and what is hit goes back to its document
    # (equal texts hold equal passages, so the digest of a text stands for it)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = docs.select(*keep, text.alias("text"), F.xxhash64(text).alias("_h"), F.crc32(text).alias("_c"))

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            words, hashes = _tokens(texts)
            doc, h, c = words.doc(), batch.column("_h").to_numpy(), batch.column("_c").to_numpy()
            for n in short:
                g = gram_hashes(hashes, n)
                whole = np.flatnonzero(doc[: len(g)] == doc[n - 1 :])
                yield pa.RecordBatch.from_pydict({
                    "_h": h[doc[whole]], "_c": c[doc[whole]], "gram": _signed(g[whole]), "at": (whole - words.first[doc[whole]]).astype(np.int32), "n": np.full(len(whole), n, np.int32),
                })

    all_grams = placed.select("_h", "_c", "text").mapInArrow(every, "_h long, _c long, gram long, at int, n int")
    hit = all_grams.join(seed_rows, "gram").filter(F.least("size", F.lit(GRAM)) == F.col("n"))
    grouped = hit.groupBy("_h", "_c").agg(F.collect_set(F.struct("item", "size", "at", "place")).alias("hits"))

    def clusters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            words, _ = _tokens(texts)
            data, rows = words.flat.tobytes(), []
            for k, found in enumerate(batch.column("hits").to_pylist()):
                rows += [row(words, data, k, *window) for window in _windows([tuple(h.values()) for h in found], int(words.counts[k]))]
            if rows:
                taken = batch.take(pa.array([r[0] for r in rows]))
                columns = [pa.array(c, t) for c, t in zip(list(zip(*rows))[1:], types)]
                yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in keep), *columns], out.names)

    back = placed.join(grouped, ["_h", "_c"]).select(*keep, "text", "hits")
    return back.mapInArrow(clusters, out)


def smith_waterman(passage: list[str], item: list[str]) -> tuple[int, int, int, int]:
    """(points, equal words, first, end) of the best local alignment; ties: the one that ends first. Rows are numpy vectors:
    a gap along the item is a running maximum."""
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(item))}
    b = np.array([vocabulary[w] for w in item])
    m = len(b)
    steps = np.arange(m + 1) * -GAP
    score, equal, first = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    best = (0, 0, 0, 0)
    for i, w in enumerate(passage):
        same = b == vocabulary.get(w, -1)
        diagonal = score[:-1] + np.where(same, MATCH, OTHER)
        up = score[1:] + GAP
        begin = (score[:-1] == 0) & (diagonal > 0)
        value = np.zeros(m + 1, np.int64)
        value[1:] = np.maximum(np.maximum(diagonal, up), 0)
        e, f = np.zeros(m + 1, np.int64), np.full(m + 1, i + 1)
        on_diagonal = (diagonal >= up) & (diagonal > 0)
        e[1:] = np.where(on_diagonal, equal[:-1] + same, np.where(up > 0, equal[1:], 0))
        f[1:] = np.where(on_diagonal, np.where(begin, i, first[:-1]), np.where(up > 0, first[1:], i + 1))
        # gaps along the item: the best of the earlier cells, less a gap for each step
        lifted = value + steps
        source = np.maximum.accumulate(np.where(lifted == np.maximum.accumulate(lifted), np.arange(m + 1), 0))
        along = value[source] - (steps - steps[source])
        take = along > value
        score = np.where(take, along, value)
        equal, first = np.where(take, e[source], e), np.where(take, f[source], f)
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(equal[k]), int(first[k]), i + 1)
    return best


def best_passages(windows: list[tuple[int, list[str]]], item: list[str]) -> list[tuple[int, int, int, int]]:
    """(points, equal words, first, end) of the passages of a document, given as windows (first word, words), that reach the
    bounds. The best comes first, and what lies beside it in the windows it touches is aligned again, so no two overlap."""
    vocabulary, enough = set(item), max(SCORE * len(item), min(len(item), EQUAL_WORDS))

    def aligned(first: int, words: list[str]) -> Iterator[tuple]:
        # no alignment has more equal words than the window has words of the item
        if sum(w in vocabulary for w in words) >= enough:
            points, equal, a, b = smith_waterman(words, item)
            if points >= SCORE * MATCH * len(item) and equal >= min(len(item), EQUAL_WORDS):
                yield points, equal, first + a, first + b, first, words

    left, out = [x for window in windows for x in aligned(*window)], []
    while left:
        best = max(left, key=lambda x: (x[0], -x[2]))
        begin, end = best[2:4]
        out.append(best[:4])
        again: list = []
        for x in left:
            first, words = x[4:]
            if x is not best and (x[3] <= begin or end <= x[2]):
                again.append(x)
            else:
                again += [*aligned(first, words[: max(0, begin - first)]), *aligned(max(first, end), words[max(0, end - first) :])]
        left = again
    return sorted(set(out), key=lambda x: x[2])


def align(found: DataFrame, items: DataFrame, keep: list[str], key: str = "item_id") -> DataFrame:
    """The passages with the points of their best alignment and its place in the document, those that reach the bounds."""
    texts = items.select(F.col(key).alias("item"), F.col("text").cast("string").alias("item_text"))
    scored = [f for f in found.schema if f.name not in ("first_words", "passages")]
    out = T.StructType([*scored, *T.StructType.fromDDL("score double, item_words int, equal_words int, begin_word int, end_word int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                words, _ = _tokens(batch.column("item_text").fill_null("").cast(pa.large_string()))
                data, rows = words.flat.tobytes(), []
                spans = list(zip(words.starts.tolist(), words.ends.tolist()))
                for k, (firsts, passages) in enumerate(zip(batch.column("first_words").to_pylist(), batch.column("passages").to_pylist())):
                    item = [data[s:e].decode() for s, e in spans[words.first[k] : words.first[k + 1]]]
                    rows += [(k, points / (MATCH * len(item)), len(item), *rest) for points, *rest in best_passages(list(zip(firsts, passages)), item)]
                if rows:
                    at, score, *rest = zip(*rows)
                    taken = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*(taken.column(f.name) for f in scored), pa.array(score, pa.float64()), *(pa.array(c, pa.int32()) for c in rest)], out.names)

    return found.join(texts, "item").select(*found.columns, "item_text").mapInArrow(run, out)


def contaminated(docs: DataFrame, items: DataFrame, keep: list[str], key: str = "item_id") -> DataFrame:
    """``keep`` columns, item, score (1: the whole item), equal_words, begin_word and end_word of every passage of a document
    that is a copy, or an edited copy, of a benchmark item."""
    grams = stage(item_grams(items, key), "item-grams")
    short = sorted(r.n for r in grams.select(F.least("size", F.lit(GRAM)).alias("n")).distinct().collect()) or [GRAM]
    found = passages(docs, grams, keep, grams.collect() if small_enough(grams, MOST_GRAMS) else None, short)
    return align(found, items, keep, key)
