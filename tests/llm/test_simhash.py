"""SimHash groups against a plain version; edge rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from hearthline.llm import simhash
from hearthline.llm.components import groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    runs = [words[i : i + size] for i in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows: list[tuple[int | None, int]], radius: int) -> list[tuple]:
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f: int) -> int:
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return sorted(((d, f"{f:016x}", least.get(root(f))) for d, f in rows), key=repr)


def got(spark, docs, radius=3):
    out = simhash.near_duplicates(docs, radius=radius).collect()
    return sorted(((r.doc_id, f"{r.fp[0] % (1 << 64):016x}", r.component_id) for r in out), key=repr)


def test_same_as_plain(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(60)]
    near = []
    for t in texts[:30]:
        words = t.split()
        if words:
            words[rng.randrange(len(words))] = "Changed"
        near.append(" \t".join(words))
    rows = list(enumerate(texts + near + texts[:10] + ["", None, "\n \t", "one", "ONE two", "É É é"])) + [(3, texts[3]), (None, texts[4]), (None, None)]
    want = plain_groups([(d, plain_fingerprint(t)) for d, t in rows], 3)
    assert got(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == want
    wide = plain_groups([(d, plain_fingerprint(t)) for d, t in rows], 12)
    assert got(spark, spark.createDataFrame(rows, "doc_id long, text string"), 12) == wide
    assert len({w[2] for w in wide}) < len({w[2] for w in want})


def test_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    monkeypatch.setattr(simhash, "RUN", 2)
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = base + [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in base * 2]
    rows = [(i, [f - (1 << 64) if f >> 63 else f]) for i, f in enumerate(dict.fromkeys(fps))]
    edges = simhash.links(spark.createDataFrame(rows, "doc_id long, fp array<bigint>").select("fp"), 3)
    roots = {r.node[0]: r.root[0] for r in groups(edges, "a", "b").collect()}
    want = plain_groups([(i, f[0] % (1 << 64)) for i, f in rows], 3)
    mine: dict[int, list[int]] = {}
    for i, f in rows:
        mine.setdefault(roots.get(f[0], f[0]), []).append(i)
    assert sorted(map(sorted, mine.values())) == sorted(sorted(i for i, _, g in want if g == c) for c in {g for _, _, g in want})


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    extra = spark.createDataFrame([(1, "a b c d", "x", 5), (2, "a b c d", None, None)], "doc_id long, text string, fp string, n int")
    assert sorted((r.doc_id, r.n, r.component_id) for r in simhash.near_duplicates(extra).collect()) == [(1, 5, 1), (2, None, 1)]


def test_chain_and_star_groups(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (7, 7)]
    found = groups(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    roots = {r.node: r.root for r in found if r.node != r.root}
    assert roots == {**{i: 0 for i in range(1, 31)}, **{100 + i: 100 for i in range(1, 50)}, 201: 200}


def plain_copies(fps: dict[int, int], sets: dict[int, set]) -> list[int]:
    """The least id of each group of copies, all pairs compared."""
    parent = {k: k for k in fps}

    def root(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    words = np.array([[f >> 64 * n & (1 << 64) - 1 for n in range(simhash.COPY_WORDS64)] for f in fps.values()], np.uint64)
    ids = list(fps)
    for i, a in enumerate(ids):
        bits = np.bitwise_count(words[:i] ^ words[i])
        for j in np.flatnonzero((bits.sum(1) <= simhash.COPY_RADIUS) & (bits[:, 0] <= simhash.COPY_FIRST)).tolist():
            b = ids[j]
            if len(sets[a] & sets[b]) >= simhash.SIMILARITY * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(k for k in ids if root(k) == k)


@pytest.mark.parametrize("tile", [simhash.TILE_SHINGLES, 400])
def test_families_around_the_similarity(spark, monkeypatch, tile):
    """Of a family, a link that the shortest forest leaves out can be the only one that is similar enough."""
    monkeypatch.setattr(simhash, "TILE_SHINGLES", tile)
    rng = random.Random(11)
    rows = []
    for family in range(200):
        base = [f"f{family}w{k}" for k in range(150)]
        for _ in range(6):
            text = list(base)
            for k in rng.sample(range(150), rng.randint(1, 4)):
                text[k] = f"new{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = simhash.fingerprints(docs, simhash.COPY_SHINGLE, simhash.COPY_WORDS64).collect()
    fps = {r.doc_id: sum((f % (1 << 64)) << 64 * n for n, f in enumerate(r.fp)) for r in found}
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(146)} for k, t in rows}
    assert sorted(r.doc_id for r in simhash.one_of_each_group(docs).collect()) == plain_copies(fps, sets)
