"""Line dedup: a segment-partition edit join over distinct lines, then removal of every later occurrence.

Built-in functions only. A line counts without the blanks around it; one of blanks alone never does. Two lines of MIN_CHARS
characters or more are linked within THRESHOLD edits of characters; shorter ones, in which two edits can be another word, must be
equal. Of linked or equal lines the first occurrence (by doc_id, null first, then line number) stays: an occurrence goes if an
equal line, or a line linked to it, occurs earlier. Equal short lines are told apart by 96 bits of hashes.

Null and empty texts have one empty line; texts of any length are split into their lines; rows of one doc_id and one text have
the same places and lose the same lines; an empty table gives none; other columns stay as they are, but for those that the result
names itself and those called _text, _key, _doc, _hash, _lines, _gone or _n_links. ``doc_id`` is an integer, or the text of one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hearthline.llm.common import BLANK, small_enough, stage, text_or_empty

THRESHOLD = 2
MIN_CHARS = 40
#: Lines with candidates up to which their keys are broadcast to fetch their texts (16 bytes each); beyond, they are joined.
MOST_LINES = 500_000
LETTERS = "etaoinsrhldumc"


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, line and place (orders occurrences) of every line that counts."""
    base = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(-(1 << 63)).cast("decimal(20,0)")) * 2147483648  # once a text
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), base.alias("base"), text_or_empty().alias("text"))
        .select("doc_id", "text_hash", "base", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
        .select("doc_id", "text_hash", "base", "pos", F.btrim("raw", F.lit(BLANK)).alias("line"))
        .filter(F.col("line") != "")
        .select("doc_id", "text_hash", "pos", "line", (F.col("base") + F.col("pos")).cast("decimal(38,0)").alias("place"))
    )


def _segment(length: Column, i: Column, threshold: int) -> tuple[Column, Column]:
    """Begin (from 0) and length of segment i of a line: the later ones take the remainder."""
    parts = threshold + 1
    size, more = F.floor(length / parts).cast("int"), length % parts
    return size * i + F.greatest(F.lit(0), more - parts + i), size + (more >= parts - i).cast("int")


def _key(line: Column, length: Column, i: Column, shift: Column, threshold: int, simple: Column) -> Column:
    """The hash of what stands where a line of ``length`` characters would have its segment i, moved by ``shift``. In ``simple``
    lines each character is a byte, so that none need be counted."""
    begin, size = _segment(length, i, threshold)
    part = F.when(simple, F.substring(line.cast("binary"), begin + shift + 1, size)).otherwise(F.substring(line, begin + shift + 1, size).cast("binary"))
    # 48 bits: candidates are checked, and there are many probes
    return F.xxhash64(i, length, part).bitwiseAND(F.lit((1 << 48) - 1))


def _moves(threshold: int) -> list[tuple[int, int, int]]:
    """(less, i, shift) of all substrings that can equal segment i of a line shorter by ``less``. Segment i can be moved by i
    edits before it at most, and by what the difference and the edits behind it leave."""
    return [
        (less, i, shift)
        for less in range(threshold + 1)
        for i in range(threshold + 1)
        for shift in range(max(-i, less - (threshold - i)), min(i, less + threshold - i) + 1)
    ]


def _tally(line: Column) -> Column:
    """The counts of the commonest letters, each modulo 4, in one small number. Each letter is counted in what the earlier ones
    left, which is ever shorter."""
    left = [line]
    for c in LETTERS:
        left.append(F.replace(left[-1], F.lit(c), F.lit("")))
    counts = [F.octet_length(a) - F.octet_length(b) for a, b in zip(left, left[1:])]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(n.bitwiseAND(F.lit(3)), 2 * k) for k, n in enumerate(counts)])


def _tallies_apart(x: Column, y: Column) -> Column:
    """A lower bound of twice the edits between two lines: one edit changes two counts by one at most."""
    each = lambda v, k: F.shiftright(v, 2 * k).bitwiseAND(F.lit(3))
    apart = [F.abs(each(x, k) - each(y, k)) for k in range(len(LETTERS))]
    return reduce(lambda a, b: a + b, [F.least(d, 4 - d) for d in apart])


def within(a: str, b: str, threshold: int = THRESHOLD) -> Column:
    """Whether two text columns, of which ``a`` is not the longer but longer than the threshold, differ by at most so many edits.

    A bit-parallel column step over the diagonal band of 2 * threshold + 1 cells: bit k of a word stands for the cell
    ``threshold - k`` rows above the diagonal, ``vp`` and ``vn`` mark the cells one more and one less than the cell above,
    and ``d`` follows the last row of the band down to the end of ``a``, then along it.
    """
    k = threshold
    width = 2 * k + 1
    full = (1 << width) - 1
    eq = " | ".join(f"if(get(x.a, j - {k} + {n}) = get(x.b, j), {1 << n}, 0)" for n in range(width))
    return F.expr(f"""
        exists(array(struct(split({a}, '') AS a, split({b}, '') AS b)), x ->
          aggregate(
            sequence(0, size(x.b) - 1),
            named_struct('vp', {full - ((1 << k) - 1)}, 'vn', 0, 'd', {k}),
            (s, j) -> transform(array(named_struct('eq', {eq}, 'vp', s.vp, 'vn', s.vn, 'd', s.d)), q ->
              transform(array(named_struct('d0', ((((q.eq & q.vp) + q.vp) ^ q.vp) | q.eq | q.vn) & {full}, 'vp', q.vp, 'vn', q.vn, 'd', q.d)), w ->
                transform(array(named_struct('d0', w.d0, 'hp', (w.vn | ~(w.d0 | w.vp)) & {full}, 'hn', w.d0 & w.vp, 'd', w.d)), h ->
                  named_struct(
                    'vp', (h.hn | ~(shiftright(h.d0, 1) | h.hp)) & {full},
                    'vn', shiftright(h.d0, 1) & h.hp,
                    'd', h.d + if(j + {k} < size(x.a), 1 - (shiftright(h.d0, {width - 1}) & 1),
                      (shiftright(h.hp, size(x.a) - 1 - j + {k}) & 1) - (shiftright(h.hn, size(x.a) - 1 - j + {k}) & 1))))[0])[0])[0]
          ).d <= {k})
    """)


def links(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """a and b (ids) of all pairs of distinct lines (id, line, tally) within the threshold."""
    moves = [F.struct(*(F.lit(x).alias(n) for x, n in zip(m, ("less", "i", "shift")))) for m in _moves(threshold)]
    columns = "length", "line", "tally", "simple"
    # the length once a line; then a row for each segment or move, with one small expression for the key
    measured = lines.select("id", F.length("line").alias("length"), "line", "tally", (F.length("line") == F.octet_length("line")).alias("simple"))
    segments = measured.select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(threshold))).alias("i"), *columns)
    index = segments.select(_key(F.col("line"), F.col("length"), F.col("i"), F.lit(0), threshold, F.col("simple")).alias("key"), "a", F.col("tally").alias("tally_a"))
    moved = measured.select(F.col("id").alias("b"), F.explode(F.array(*moves)).alias("m"), *columns).select("b", "m.*", *columns)
    probe = moved.select(_key(F.col("line"), F.col("length") - F.col("less"), F.col("i"), F.col("shift"), threshold, F.col("simple")).alias("key"), "b", F.shiftleft("tally", 2).bitwiseOR(F.col("less")).alias("more"))
    # tally and difference share a number, as there are many probes
    assert threshold < 4
    less, tally_b = F.col("more").bitwiseAND(F.lit(3)), F.shiftright("more", 2)
    close = (_tallies_apart(F.col("tally_a"), tally_b) <= 2 * threshold) & ((less > 0) | (F.col("a") < F.col("b")))
    pairs = stage(index.join(probe, "key").filter(close & (F.col("a") != F.col("b"))).select("a", "b").distinct(), "line-pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids = F.broadcast(ids) if small_enough(ids, MOST_LINES) else ids
    texts = stage(lines.select("id", "line").join(ids, "id"), "line-texts")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b"
    )
    return both.filter(within("line_a", "line_b", threshold)).select("a", "b")


def line_dedup(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every row with ``n_lines``, ``n_removed``, ``n_links`` (links of its lines to other lines) and ``cleaned``, its text
    without the removed lines."""
    lines = _lines(docs)
    hashes = F.xxhash64("line").alias("h"), F.crc32("line").alias("c")
    long = F.length("line") >= min_chars
    # one exchange: long lines by their text, short ones by hashes
    keys = F.when(long, F.col("line")).alias("line"), *[F.when(~long, h).alias(n) for h, n in zip(hashes, "hc")]
    distinct = lines.select(*keys, "place").groupBy("line", "h", "c").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    distinct = distinct.filter("line IS NOT NULL OR n > 1")
    # with the hashes of long lines too, so that no later join carries their texts
    whole = {n: F.coalesce(n, h) for h, n in zip(hashes, "hc")}
    distinct = stage(distinct.withColumns({**whole, "id": F.monotonically_increasing_id(), "tally": _tally(F.col("line"))}), "lines")
    edges = stage(links(distinct.filter("line IS NOT NULL").select("id", "line", "tally"), threshold), "line-links")
    ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = ways.join(distinct.select(F.col("id").alias("b"), "first"), "b").groupBy("a").agg(F.min("first").alias("near"), F.count("*").alias("links"))
    marked = distinct.join(around.withColumnRenamed("a", "id"), "id", "left").filter("n > 1 OR links > 0").select(
        "h", "c", F.least("first", "near").alias("stays"), F.coalesce("links", F.lit(0)).alias("links")
    )
    spots = lines.select("doc_id", "text_hash", "pos", "place", *hashes).join(marked, ["h", "c"])
    by_doc = spots.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.when(F.col("place") > F.col("stays"), F.col("pos"))).alias("gone"),
        F.collect_set(F.struct("pos", "links")).alias("linked"),
    )
    found = by_doc.select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("gone").alias("_gone"),
        F.aggregate("linked", F.lit(0).cast("long"), lambda s, x: s + x.links).alias("_n_links"),
    )
    full = docs.withColumn("_text", text_or_empty()).withColumn("_key", F.xxhash64("text"))
    joined = full.join(found, (F.col("_key") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left").withColumn("_lines", F.split("_text", "\n"))
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    return joined.withColumns({
        "n_lines": F.size("_lines").cast("long"),
        "n_removed": F.size(gone).cast("long"),
        "n_links": F.coalesce("_n_links", F.lit(0)).cast("long"),
        "cleaned": F.when(F.size(gone) == 0, F.col("_text")).otherwise(
            F.array_join(F.filter("_lines", lambda x, i: ~F.array_contains(gone, i)), "\n")
        ),
    }).drop("_text", "_key", "_doc", "_hash", "_lines", "_gone", "_n_links")
