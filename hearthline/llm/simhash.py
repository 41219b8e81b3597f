"""SimHash near-duplicates: fingerprints, tiled exact comparison by exclusive-or and bit counts, and connected groups.

A row without words (null, empty or blank text) has fingerprint zero and is linked like any other. Rows of equal fingerprint
are one node of the link graph, so a group of copies is compared once. Repeated rows give repeated results, rows with a null
id get the group of their fingerprint, an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import Words, lowered, mix, pieces, stage, utf8
from hearthline.llm.components import groups

#: Fingerprints of one bit count that one tile holds at most (in the mean, by hash).
TILE = 16_384
#: Fingerprints of one run inside a tile, with its own bounds of partial bit counts.
RUN = 128
#: Comparisons for one task.
WORK = 1 << 28


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every run of ``size`` words joined by spaces (a shorter text is one run), and how many each text has."""
    shut = np.zeros(len(words.flat), bool)
    shut[words.ends[words.ends < len(words.flat)]] = True
    keep = ~words.blank | shut
    at = np.cumsum(keep) - keep
    flat = np.where(words.blank, 32, words.flat)[keep]
    data = flat.astype(np.uint8).tobytes()
    starts, stops = at[words.starts], at[words.ends - 1] + 1
    n = words.counts
    many = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    base = np.repeat(words.first[:-1], many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    opens = base + nth
    shuts = opens + np.repeat(np.minimum(n, size), many) - 1
    # a text's first word may follow another text without a blank between: spans never cross texts, so that is harmless
    h = xxhash.xxh64_intdigest
    out = [h(data[a:b], 42) for a, b in zip(starts[opens].tolist(), stops[shuts].tolist())]
    return np.array(out, np.uint64), many


def majority_bits(hashes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each text 64 bits: those set in over half of its hashes."""
    out = np.zeros(len(many), np.uint64)
    full = np.flatnonzero(many)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = (np.cumsum(many) - many)[full]
        sums = np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
        over = 2 * sums > many[full][:, None]
        out[full] = np.packbits(over, axis=1, bitorder="little").reshape(-1).view(np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, words64: int = 1) -> DataFrame:
    """All columns of ``docs`` but the text, and ``fp``: an array of ``words64`` 64-bit integers. Beyond the first, hashes are
    remixed, so that more bits estimate the similarity more closely."""
    rest = [c for c in docs.columns if c not in ("text", "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            flat, bounds = utf8(texts)
            hashes, many = shingle_hashes(Words(lowered(flat), bounds), shingle)
            each = [majority_bits(mix(hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) if k else hashes, many) for k in range(words64)]
            fp = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(each, 1).reshape(-1).view(np.int64)), words64).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), fp], [*rest, "fp"])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("fp", T.ArrayType(T.LongType(), False))])
    return docs.select(*rest, docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[:, :1].view(np.uint16).reshape(len(fp), 4)).astype(np.int16)


def _near(a: np.ndarray, b: np.ndarray, radius: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two tiles have a partner in the other. Runs whose quarters of the first 64 bits have bit counts too
    far apart in sum are skipped; no pair within ``first`` bits is lost by that."""
    qa, qb = _quarters(a), _quarters(b)
    hit_a, hit_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    low_b = np.minimum.reduceat(qb, np.arange(0, len(b), RUN))
    top_b = np.maximum.reduceat(qb, np.arange(0, len(b), RUN))
    for i in range(0, len(a), RUN):
        q = qa[i : i + RUN]
        gap = np.maximum(low_b - q.max(0), 0) + np.maximum(q.min(0) - top_b, 0)
        for j in np.flatnonzero(gap.sum(1) <= first) * RUN:
            close = np.bitwise_count(a[i : i + RUN, None, 0] ^ b[None, j : j + RUN, 0]) <= first
            if close.any():
                x, y = np.nonzero(close)
                far = np.bitwise_count(a[i + x] ^ b[j + y]).sum(1) <= radius
                if a is b:
                    far &= i + x != j + y
                hit_a[i + x[far]] = True
                hit_b[j + y[far]] = True
    return hit_a, hit_b


def _tree(fp: np.ndarray, radius: int, first: int) -> Iterator[tuple[int, int, int]]:
    """Edges (with distance) of a shortest spanning forest over all links between these fingerprints, grown one row at a
    time: all pairs are compared, but no more edges than rows come out."""
    n = len(fp)
    best = np.full(n, 1 << 30)
    parent = np.full(n, -1)
    inside = np.zeros(n, bool)
    for _ in range(n):
        k = int(np.argmin(np.where(inside, 1 << 31, best)))
        inside[k] = True
        if parent[k] >= 0:
            yield int(parent[k]), k, int(best[k])
        bits = np.bitwise_count(fp ^ fp[k])
        d = bits.sum(1).astype(np.int64)
        closer = (d <= radius) & (bits[:, 0] <= first) & (d < best) & ~inside
        best[closer], parent[closer] = d[closer], k


def links(fps: DataFrame, radius: int, first: int | None = None) -> DataFrame:
    """Links a, b (fingerprints) and distance between different fingerprints (column ``fp``, distinct), within ``radius``
    bits in all and ``first`` bits of the first 64. All tile pairs that bit counts allow are compared exactly; of the links
    of one pair a spanning forest of the shortest ones comes out, so the groups that links form are whole.

    A tile is a hash class of the fingerprints of ``first`` + 1 neighbouring bit counts (of the first 64 bits), and meets the
    tiles of its own and of the next counts. The driver sees one row for each bit count.
    """
    first = radius if first is None else first
    counted = fps.select("fp", F.floor(F.bit_count(F.col("fp")[0]) / (first + 1)).cast("int").alias("ones"))
    rows = {r.ones: r.n for r in counted.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    sizes = {k: -(-n // TILE) for k, n in rows.items()}
    if not sizes:
        return counted.select(F.col("fp").alias("a"), F.col("fp").alias("b"), F.lit(0).alias("distance")).limit(0)
    tiles_of = F.create_map(*[F.lit(x) for item in sizes.items() for x in item])
    tiles = (
        counted.withColumn("tile", F.pmod(F.xxhash64("fp"), tiles_of[F.col("ones")]).cast("int"))
        .groupBy("ones", "tile").agg(F.flatten(F.collect_list("fp")).alias("rows"))
    )
    tiles = stage(tiles, "simhash-tiles")
    # partner tiles: of the same bit counts from the own tile on, and all of the next
    reach = F.filter(F.array(F.col("ones"), F.col("ones") + 1), lambda p: F.map_contains_key(tiles_of, p))
    partners = tiles.select("ones", "tile", F.explode(reach).alias("other")).select(
        "ones", "tile", "other",
        F.explode(F.sequence(F.when(F.col("other") == F.col("ones"), F.col("tile")).otherwise(0), tiles_of[F.col("other")].cast("int") - 1)).alias("other_tile"),
    )
    left = tiles.withColumnRenamed("rows", "x")
    right = tiles.select(F.col("ones").alias("other"), F.col("tile").alias("other_tile"), F.col("rows").alias("y"))
    pairs = partners.join(left, ["ones", "tile"]).join(right, ["other", "other_tile"]).select(
        "x", "y", ((F.col("ones") == F.col("other")) & (F.col("tile") == F.col("other_tile"))).alias("same")
    )
    words64 = fps.select(F.size("fp").alias("n")).first().n

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (np.array(batch.column(c)[k].values).view(np.uint64).reshape(-1, words64) for c in (0, 1))
                order = lambda t: t[np.lexsort(_quarters(t).T[::-1])]
                x = order(x)
                y = x if batch.column(2)[k].as_py() else order(y)
                hit_x, hit_y = _near(x, y, radius, first)
                fp = x[hit_x | hit_y] if y is x else np.concatenate([x[hit_x], y[hit_y]])
                edges = list(_tree(fp, radius, first))
                if edges:
                    a, b, d = (np.array(c) for c in zip(*edges))
                    lists = [pa.FixedSizeListArray.from_arrays(pa.array(fp[i].reshape(-1).view(np.int64)), words64).cast(pa.list_(pa.int64())) for i in (a, b)]
                    yield pa.RecordBatch.from_arrays([*lists, pa.array(d, pa.int32())], ["a", "b", "distance"])

    schema = "a array<bigint>, b array<bigint>, distance int"
    n_pairs = sum(sizes[p] * sizes.get(q, 0) for p in sizes for q in (p, p + 1))
    work = sum(rows[p] * rows.get(q, 0) for p in rows for q in (p, p + 1))
    tasks = max(work // WORK, 2 * fps.sparkSession.sparkContext.defaultParallelism)
    return pairs.repartition(min(n_pairs, tasks)).mapInArrow(compare, schema)


def near_duplicates(docs: DataFrame, shingle: int = 3, words64: int = 1, radius: int = 3, first: int | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, ``fp``, and ``component_id``: the smallest doc_id reachable over links."""
    fps = stage(fingerprints(docs, shingle, words64), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = stage(links(nodes.select("fp"), radius, first), "simhash-links")
    return with_components(fps, nodes, edges)


def with_components(fps: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    roots = groups(edges, "a", "b")
    linked = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
    named = linked.withColumn("root", F.coalesce("root", "fp"))
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(named.join(first, "root").select("fp", "component_id"), "fp")


def shingle_sets(docs: DataFrame, key: str, size: int) -> DataFrame:
    """The key and the distinct shingle hashes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text", 1 << 20):
            flat, bounds = utf8(texts)
            hashes, many = shingle_hashes(Words(lowered(flat), bounds), size)
            sets = [np.unique(x).view(np.int64) for x in np.split(hashes, np.cumsum(many)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(sets, pa.list_(pa.int64()))], [key, "shingles"])

    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL("shingles array<bigint>").fields])
    return docs.select(key, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


#: For groups of similar texts: 256 bits of 5-word shingles. Texts of similarity 0.8 differ in 39 bits in the mean, with a
#: deviation of 6, and in 10 of the first 64, with a deviation of 3; unrelated ones differ in 128.
COPY_SHINGLE, COPY_WORDS64, COPY_RADIUS, COPY_FIRST, SIMILARITY = 5, 4, 54, 20, 0.8
#: Shingles that one tile of texts holds at most where fragments are compared (in the mean, by hash).
TILE_SHINGLES = 1 << 18


def _joins(x: pa.StructArray, y: pa.StructArray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of fingerprints of two tiles (fp, fragment, shingles) that are candidates and similar, enough of them to join
    all the fragments that such pairs join."""
    def parts(t: pa.StructArray) -> tuple[np.ndarray, ...]:
        fp, names, sets = t.flatten()
        return *(np.array(c.flatten()).reshape(len(t), -1) for c in (fp, names)), np.array(sets.flatten()), np.array(sets.value_lengths())

    (fp, names, flat, sizes), (fp_y, names_y, flat_y, sizes_y) = parts(x), parts(y)
    of = np.unique(np.concatenate([names, names_y]), axis=0, return_inverse=True)[1].reshape(-1)
    of, of_y = of[: len(names)], of[len(names) :]
    joined = np.arange(len(names) + len(names_y))
    keys, each = np.unique(np.concatenate([flat, flat_y]), return_inverse=True)
    each, each_y = each[: len(flat)], each[len(flat) :]
    shuts, shuts_y = np.cumsum(sizes), np.cumsum(sizes_y)
    held = np.zeros(len(keys), bool)
    for i in range(len(fp)):
        bits = np.bitwise_count((fp[i] ^ fp_y).view(np.uint64))
        ready = (joined[of_y] != joined[of[i]]) & (bits.sum(1) <= COPY_RADIUS) & (bits[:, 0] <= COPY_FIRST)
        if same:
            ready[: i + 1] = False
        if not ready.any():
            continue
        mine = each[shuts[i] - sizes[i] : shuts[i]]
        held[mine] = True
        sums = np.concatenate([[0], np.cumsum(held[each_y])])
        held[mine] = False
        common = sums[shuts_y] - sums[shuts_y - sizes_y]
        for j in np.flatnonzero(ready & (common >= SIMILARITY * (sizes[i] + sizes_y - common))).tolist():
            if joined[of[i]] != joined[of_y[j]]:
                joined[joined == joined[of_y[j]]] = joined[of[i]]
                yield fp[i], fp_y[j]


def joins(texts: DataFrame) -> DataFrame:
    """Links a, b between fragments: of all candidates between different fragments of an area, those whose shingles are
    similar, as far as they join fragments. ``texts``: fp, shingles, area, fragment.

    Texts of an area are dealt over tiles by hash, those of a large fragment over tiles of its own that do not meet.
    """
    def sized(*keys: str) -> DataFrame:
        return texts.groupBy(*keys).agg(F.sum(F.size("shingles")).alias("n"))

    large = sized("area", "fragment").filter(F.col("n") > TILE_SHINGLES).select("area", "fragment", F.col("fragment").alias("own"))
    parted = stage(texts.join(large, ["area", "fragment"], "left").withColumn("own", F.coalesce("own", F.array().cast("array<bigint>"))), "simhash-fragments")
    many = parted.groupBy("area", "own").agg(F.ceil(F.sum(F.size("shingles")) / TILE_SHINGLES).alias("tiles"))
    dealt = parted.join(many, ["area", "own"]).withColumn("tile", F.pmod(F.xxhash64("fp"), F.greatest("tiles", F.lit(1))))
    tiles = dealt.groupBy("area", "own", "tile").agg(F.collect_list(F.struct("fp", "fragment", "shingles")).alias("x"))
    tiles = stage(tiles.withColumn("id", F.monotonically_increasing_id()), "simhash-fragment-tiles")
    ids = tiles.select("area", "own", "id")
    partners = ids.join(ids.select("area", F.col("own").alias("own_y"), F.col("id").alias("id_y")), "area").filter(
        "id <= id_y AND (own <> own_y OR size(own) = 0)"
    ).select("id", "id_y")
    pairs = partners.join(tiles.select("id", "x"), "id").join(tiles.select(F.col("id").alias("id_y"), F.col("x").alias("y")), "id_y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = list(_joins(batch.column(0)[k].values, batch.column(1)[k].values, batch.column(2)[k].as_py()))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([list(f[c]) for f in found], pa.list_(pa.int64())) for c in (0, 1)], ["a", "b"])

    return pairs.select("x", "y", (F.col("id") == F.col("id_y")).alias("same")).mapInArrow(compare, "a array<bigint>, b array<bigint>")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows that stay when of each group of copies and near copies the one with the smallest doc_id is kept (null ids
    last, equal ids by text hash, equal rows once).

    Links between fingerprints within COPY_RADIUS are candidates, and stand if the sets of 5-word shingles have at least
    SIMILARITY of their union in common. First the shortest candidates that span each area are tested; where that leaves an
    area in several fragments, all candidates between different fragments are.
    """
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    fps = stage(fingerprints(keyed.select("doc_id", "_text_hash", "text"), COPY_SHINGLE, COPY_WORDS64), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text_hash")
    nodes = stage(fps.groupBy("fp").agg(F.min(row).alias("row")), "simhash-nodes")
    close = stage(links(nodes.select("fp"), COPY_RADIUS, COPY_FIRST), "simhash-links")
    ends = close.select(F.col("a").alias("fp")).unionByName(close.select(F.col("b").alias("fp"))).distinct()
    hashes = nodes.join(ends, "fp").select("fp", F.col("row._text_hash").alias("_text_hash"))
    texts = hashes.join(keyed.select("_text_hash", "text").dropDuplicates(["_text_hash"]), "_text_hash")
    sets = stage(shingle_sets(texts, "fp", COPY_SHINGLE), "simhash-shingles")
    both = close.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    edges = stage(both.filter(common >= SIMILARITY * (F.size("x") + F.size("y") - common)).select("a", "b"), "simhash-links")
    areas = groups(close, "a", "b").select(F.col("node").alias("fp"), F.col("root").alias("area"))
    fragments = groups(edges, "a", "b").select(F.col("node").alias("fp"), F.col("root").alias("fragment"))
    placed = areas.join(fragments, "fp", "left").withColumn("fragment", F.coalesce("fragment", "fp"))
    # an area's smallest node, which gives its name and that of its own fragment, is not among the nodes
    first = areas.select(F.col("area").alias("fp"), "area", F.col("area").alias("fragment")).distinct()
    placed = stage(placed.unionByName(first), "simhash-areas")
    several = placed.groupBy("area").agg(F.min("fragment").alias("low"), F.max("fragment").alias("high")).filter("low <> high").select("area")
    more = stage(joins(sets.join(placed.join(several, "area"), "fp")), "simhash-links")
    roots = groups(edges.unionByName(more), "a", "b").select(F.col("node").alias("fp"), "root")
    stays = (
        nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("row").alias("row"))
        .select(F.col("row.doc_id").alias("_stays"), F.col("row._text_hash").alias("_text_hash"))
    )
    left = keyed.join(stays, (keyed["_text_hash"] == stays["_text_hash"]) & keyed["doc_id"].eqNullSafe(stays["_stays"])).select(keyed["*"])
    return left.dropDuplicates(["_text_hash", "doc_id"]).drop("_text_hash")
