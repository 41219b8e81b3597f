"""Line dedup against a plain version; the band step against a plain edit distance; edge rows."""

from __future__ import annotations

import random

import pytest

from hearthline.llm import line_dedup as ld


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def edited(rng: random.Random, text: str, n: int) -> str:
    for _ in range(n):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", rng.choice("abé"), text[at] + rng.choice("abé")]) + text[at + 1 :]
    return text


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_band_step(spark, threshold):
    rng = random.Random(threshold)
    pairs = []
    for _ in range(250):
        a = "".join(rng.choices("abcé ", k=rng.randint(threshold + 1, 25)))
        b = edited(rng, a, rng.randint(0, threshold + 2))
        pairs.append(tuple(sorted((a, b), key=len)))
    pairs = [(a, b) for a, b in pairs if len(b) - len(a) <= threshold < len(a)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", ld.within("a", "b", threshold).alias("near")).collect()
    assert [(r.a, r.b) for r in got if r.near != (distance(r.a, r.b) <= threshold)] == []
    assert {r.near for r in got} == {True, False}


def plain(rows, threshold=ld.THRESHOLD, least=ld.MIN_CHARS):
    spots = [((-(1 << 63) if d is None else d, k), x.strip(" \t\n\x0b\x0c\r")) for d, t in rows for k, x in enumerate((t or "").split("\n"))]
    spots = [(p, x) for p, x in spots if x]
    first: dict[str, tuple] = {}
    for p, x in spots:
        first[x] = min(p, first.get(x, p))
    near = {x: [y for y in first if y != x and min(len(x), len(y)) >= least and abs(len(x) - len(y)) <= threshold and distance(x, y) <= threshold] for x in first}
    out = []
    for d, t in rows:
        kept, links, parts = [], 0, (t or "").split("\n")
        for k, raw in enumerate(parts):
            x, place = raw.strip(" \t\n\x0b\x0c\r"), (-(1 << 63) if d is None else d, k)
            if x:
                links += len(near[x])
            if not x or place <= min(first[y] for y in [x, *near[x]]):
                kept.append(raw)
        out.append((d, len(parts), len(parts) - len(kept), links, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [ld.MOST_LINES, 0])
def test_same_as_plain(spark, monkeypatch, most):
    monkeypatch.setattr(ld, "MOST_LINES", most)
    rng = random.Random(9)
    base = ["".join(rng.choices("abcdef é", k=rng.randint(30, 60))).strip() for _ in range(40)]
    pool = base + [edited(rng, x, n) for x in base for n in (1, 2, 3)] + ["short", "", " \t"]
    rows = [(k, "\n".join(rng.choice(["", " "]) + x for x in rng.choices(pool, k=rng.randint(1, 8)))) for k in range(40)]
    rows += [(100, None), (101, ""), (None, rows[3][1]), (102, base[0] + "\n" + base[0]), rows[5], (103, "x" * 5000), (104, "x" * 4999 + "y")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, line string, id int").repartition(3)
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.n_links, r.cleaned) for r in ld.line_dedup(docs).collect()), key=repr)
    assert got == plain(rows)
    assert sum(r[2] for r in got) > 30


def test_empty_table(spark):
    assert ld.line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_and_clashing_columns(spark):
    menu = "Home | News\nSubscribe to our letter\n"
    rows = [(str(k), f"{menu}Story number {k} of the day\n  Share \n\n", "x", "y", "z") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, gone string, n_links string, h string").repartition(3)
    got = {int(r.doc_id): r for r in ld.line_dedup(docs).collect()}
    assert got[0].cleaned == rows[0][1] and {(r.gone, r.h, r.n_links) for r in got.values()} == {("x", "z", 0)}
    assert all(got[k].cleaned == f"Story number {k} of the day\n\n" and got[k].n_removed == 3 for k in range(1, 30))


def test_keys_of_simple_lines_and_tallies(spark):
    """Lines of one-byte characters get the same keys by bytes as by characters; letters are counted in what earlier ones left,
    and tell no more than two for an edit."""
    F = ld.F
    rng = random.Random(3)
    base = ["".join(rng.choices("etaoinsrhl é" if k % 2 else "etaoinsrhldumc ", k=rng.randint(40, 80))) for k in range(40)]
    pairs = [(x, edited(rng, x, k)) for x in base for k in (0, 1, 2, 3, 6)]
    df = spark.createDataFrame(pairs, "a string, b string")
    both = [ld._key(F.col("a"), F.length("a"), F.lit(i), F.lit(0), 2, way).alias(f"{name}{i}") for i in range(3) for name, way in (("own", F.length("a") == F.octet_length("a")), ("any", F.lit(False)))]
    apart = ld._tallies_apart(ld._tally(F.col("a")), ld._tally(F.col("b"))).alias("apart")
    for (a, b), r in zip(pairs, df.select(*both, apart, ld._tally(F.col("a")).alias("tally")).collect()):
        assert [r[f"own{i}"] for i in range(3)] == [r[f"any{i}"] for i in range(3)]
        assert r.tally == sum(a.count(c) % 4 << 2 * k for k, c in enumerate(ld.LETTERS))
        assert r.apart <= 2 * distance(a, b)
