"""Repeated strings against a plain count of all windows; edge rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from hearthline.llm import suffix_dedup as sd
from hearthline.llm.suffix_dedup import anchors, suffix_dedup

import numpy as np


def plain(rows, length):
    datas = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[k : k + length] for _, x in datas for k in range(len(x) - length + 1))
    out = []
    for d, x in datas:
        gone = bytearray(len(x))
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fixture(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcdeé \n", k=n))
    shared = [text(rng.randint(50, 300)) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = [rng.choice([text(rng.randint(0, 120)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 40) :]]) for _ in range(4)]
        rows.append((k, "".join(parts)))
    for k in range(20):  # near copies of one text
        x = rows[7][1]
        at = rng.randrange(max(len(x), 1))
        rows.append((100 + k, x[:at] + rng.choice(["", "Z", "YY"]) + x[at + 1 :]))
    return rows + [(200, None), (201, ""), (202, "a" * 300), (203, "ab" * 150), (204, "x" + "a" * 90), (205, text(59)), rows[3], (None, rows[4][1]), (206, rows[205 % 60][1]), (207, shared[0] + shared[0])]


def test_anchors_are_local():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    whole = set(anchors(data, 8, 24).tolist())
    part = {a + 500 for a in anchors(data[500:1500], 8, 24).tolist()}
    assert part <= whole
    assert {a for a in whole if 540 < a < 1440} <= part


def test_same_as_plain(spark):
    for seed in (1, 2):
        rows = fixture(seed)
        docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string").repartition(3)
        got = suffix_dedup(docs, length=64, gram=6, span=20).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == plain(rows, 64)
        assert sum(r.n_removed > 0 for r in got) > 30


def test_empty_table(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_periods(spark):
    """Stretches of a short period have no anchors inside (before, one each period), and lose what a plain count finds."""
    assert len(anchors(np.frombuffer(b"x" * 40_000, np.uint8), 16, 128)) == 0
    assert len(anchors(np.frombuffer(b"lorem " * 7_000, np.uint8), 16, 128)) == 0
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    units = [word(n) for n in (1, 1, 2, 3, 4, 5)]
    rows = [(k, "".join(rng.choice([rng.choice(units) * rng.randint(5, 60), word(rng.randint(0, 90)), "one passage that stands in many of the texts "]) for _ in range(4))) for k in range(80)]
    rows += [(100, units[5] * 100), (101, units[5] * 13), (102, units[5][2:] + units[5] * 12 + "ab"), (103, "q" * 64), (104, "q" * 63 + "r"), (105, "z" * 64), (106, "y" + "z" * 64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup(docs, length=64, gram=6, span=20).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == plain(rows, 64)
    assert 30 < sum(r.n_removed > 0 for r in got) < len(rows)


def test_few_blocks_of_near_copies(spark, monkeypatch):
    """Of strings that near copies share, one member of each class is looked at in blocks (before, all of them)."""
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh ", k=3_000))
    rows = [(k, base[: 40 * k + 300] + chr(65 + k) + base[40 * k + 301 :]) for k in range(50)]
    seen = []
    stage = sd.stage
    monkeypatch.setattr(sd, "stage", lambda df, label: seen.append((label, stage(df, label))) or seen[-1][1])
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == plain(rows, 400)
    assert next(df for label, df in seen if label == "string-blocks").count() < 50 * 3_000 // 16 // 2
