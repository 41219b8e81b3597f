"""Benchmark passages against a plain dynamic program over all pairs; both ways of finding seeds; edge rows."""

from __future__ import annotations

import random
import re

import pytest

from hearthline.llm import decontaminate as d


def plain_score(a: list[str], b: list[str]) -> int:
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, above[j - 1] + (d.MATCH if x == y else d.OTHER), above[j] + d.GAP, row[j - 1] + d.GAP))
        best, above = max(best, *row), row
    return best


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def fixture():
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 40
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, line(30 + i)) for i in range(6)] + [(6, "one two"), (7, None), (8, " \n"), (9, line(8)), (None, line(20))]
    docs = [(k, line(rng.randint(0, 120))) for k in range(60)]
    for k in range(30):  # leaks: whole, with words gone, changed or added, in capitals, twice
        text = words(items[k % 6][1])
        for _ in range(k // 6):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["changed"], [text[at], "more"]])
        docs.append((100 + k, f"{line(40)}\n{' '.join(text).upper()} {line(30)}"))
    docs += [(200, f"{items[0][1]} {line(60)} {items[0][1]}"), (201, "ONE\ttwo"), (202, None), (203, ""), (None, items[2][1]), (204, f"so {items[9][1]} it is")]
    docs.append(docs[70])
    return docs, items


@pytest.mark.parametrize("bound", [d.MOST_GRAMS, 0])
def test_same_as_plain(spark, monkeypatch, bound):
    monkeypatch.setattr(d, "MOST_GRAMS", bound)
    docs, items = fixture()
    extra = spark.createDataFrame([(*r, "x", None) for r in docs], "doc_id long, text string, item string, gram int").repartition(3)
    found = d.contaminated(extra, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).collect()
    want = {
        (k, i)
        for k, text in docs
        for i, item in items
        if i is not None and words(item) and plain_score(words(text), words(item)) >= d.SCORE * d.MATCH * len(words(item)) and plain_score(words(text), words(item)) > 0
    }
    # the plain program lets a two-word item match by one word; the operator asks for min(EQUAL_WORDS, size) equal words
    want = {(k, i) for k, i in want if i != 6 or "one two" in " ".join(words(dict((a, b) for a, b in docs)[k]))}
    assert {(r.doc_id, r.item) for r in found} == want
    assert sum(r.doc_id == 200 and r.item == 0 for r in found) == 2
    assert sum(r.doc_id == docs[70][0] for r in found) == 2
    for r in found:
        text = next(t for k, t in docs if k == r.doc_id)
        score = plain_score(words(text)[r.begin_word : r.end_word], words(dict(items)[r.item]))
        assert score == round(r.score * d.MATCH * r.item_words)


@pytest.mark.parametrize("bound", [d.MOST_GRAMS, 0])
def test_regular_edits(spark, monkeypatch, bound):
    """Every 4th or 5th word changed, and counts of n-grams that only the edited copies raise."""
    monkeypatch.setattr(d, "MOST_GRAMS", bound)
    items, docs = [], []
    for size in (20, 30, 38, 59):
        for every in (4, 5):
            for start in range(every):
                k = len(items)
                item = [f"i{k}w{n}" for n in range(size)]
                items.append((k, " ".join(item)))
                docs.append((k, " ".join(["before"] * 50 + [f"x{n}" if n % every == start else w for n, w in enumerate(item)] + ["after"] * 50)))
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])
    assert sorted((r.doc_id, r.item) for r in found.collect()) == [(k, k) for k in range(len(items))]


def test_passages_do_not_overlap(spark):
    """An item that repeats a run of words: seeds on other diagonals of one copy are no second passage; copies in a row are."""
    run = [f"r{k}" for k in range(5)]
    item = run + [f"a{k}" for k in range(15)] + run + [f"b{k}" for k in range(15)]
    docs = spark.createDataFrame([(1, " ".join(["x"] * 30 + item + ["y"] * 30)), (2, " ".join(item * 3))], "doc_id long, text string")
    found = d.contaminated(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.begin_word, r.end_word) for r in found) == [(1, 30, 70), (2, 0, 40), (2, 40, 80), (2, 80, 120)]
    assert {r.score for r in found} == {1.0}


def test_alignment_equals_plain():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (rng.choices("abcd", k=rng.randint(1, 14)) for _ in range(2))
        points, equal, first, end = d.smith_waterman(a, b)
        assert points == plain_score(a, b)
        assert points == 0 or plain_score(a[first:end], b) == points


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert d.contaminated(docs, items, ["doc_id"]).count() == 0
    assert d.contaminated(some, items, ["doc_id"]).count() == 0
    assert d.contaminated(docs, some.withColumnRenamed("doc_id", "item_id"), ["doc_id"]).count() == 0
