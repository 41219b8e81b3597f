"""Token operators, sharding, quality rules, language model, toxicity and the pipeline: plain versions and edge rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from hearthline.llm import language_model, queries, sharding, simhash, toxicity
from hearthline.llm.common import new_path
from hearthline.llm.piece_codec import PieceCodec, encode_decode
from hearthline.llm.quality_rules import quality_rules
from hearthline.llm.token_counts import CACHE, token_counts

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "a", "É é ß 中文 😀\x00", "x" * 40_000, " " * 3_000, "<|endoftext|> and <s>", "don't  we'll\r\n 12,3 ▁ \x1c\x85\xa0", "Same line.\nSame line.\n"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [*enumerate(ODD), (None, "null id"), (3, "a"), (3, "a")]
    return spark.createDataFrame([(*r, "n", 1.5) for r in rows], "doc_id long, text string, n_tokens string, score double").repartition(3), rows


def test_pieces_equal_the_library(spark, odd):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    codec = PieceCodec(path)
    rng = random.Random(1)
    letters = "etaoin shr  \n.,ÄéЖ中😀▁01\r;){}"
    texts = [t or "" for t in ODD] + ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(3_000)]
    assert [codec.encode(t) for t in texts] == codec.model.encode(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in odd[1]:
        ids = codec.model.encode(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(codec.model.decode(ids))))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(odd[0], path).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_counts_equal_the_library_and_are_kept(spark, odd):
    from tokenizers import Tokenizer

    path, cache = queries.tokenizer_file("byte_bpe_50k.json"), new_path(spark, "cache")
    tokenizer = Tokenizer.from_file(path)
    want = sorted(((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in odd[1]), key=repr)
    for _ in range(2):
        got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(odd[0], path, cache).collect()]
        assert sorted(got, key=repr) == want
    kept = spark.read.schema(CACHE).parquet(cache)
    assert kept.count() == kept.select("digest").distinct().count() == len({t or "" for _, t in odd[1]})


def test_shards(spark, odd):
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(0, 400)) for k in range(600)] + [(k, "hot" * 30) for k in range(1_000, 1_400)] + odd[1] + [(7, "same row")] * 200
    got = sharding.histogram_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((repr(d), size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    shards = {s: [r for r in got if r.shard == s] for s in range(8)}
    largest, total = max(size(t) for _, t in rows), sum(size(t) for _, t in rows)
    for part in shards.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r.size for r in part) - total / 8) <= largest + 2 * sharding.TOLERANCE * total
    assert sharding.histogram_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_quality_edges(spark, odd):
    good = "".join(f"Word{k} stands beside other{k} here. " for k in range(20)).strip()
    texts = [None, "", good, good + "\n" + "home | about | news | sport | more " * 20, "menu " * 60, f"{good}\n\n{good}"]
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[k].kept for k in range(6)] == [False, False, True, False, False, False]
    assert (rows[2].n_words, rows[2].n_dup_lines, rows[2].cleaned) == (len(WORD.findall(good)), 0, good)
    assert rows[5].n_dup_lines == 1 and rows[4].n_repeat_words == 60 and rows[3].cleaned == good
    assert quality_rules(odd[0]).count() == len(odd[1])


def test_language_model(spark, odd):
    rng = random.Random(3)
    rows = odd[1] + [(k, " ".join(rng.choice([("a", "b"), ("c", "d")])[j % 2] for j in range(30)) + f" rare{k}") for k in range(100, 400)]
    training = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    tokens = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    counts = Counter(w for t in training for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((repr(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for d, t in rows)
    got = language_model.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    tests = [r for r in got if r.held_out and r.doc_id >= 100]
    assert len(tests) > 20 and sum(r.score for r in tests) > sum(r.base_score for r in tests)
    assert language_model.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_language_model_grows(spark):
    """More words than a head holds, each followed by its own: contexts beyond one part's rows and head count too."""
    rng = random.Random(5)
    pairs = [(f"first{k}", f"second{k}") for k in range(3_000)]
    rows = [(k, " ".join(" ".join(rng.choice(pairs)) for _ in range(12))) for k in range(3_000)]
    rows += [(k, "hot " * 40) for k in range(5_000, 5_400)] + [(None, rows[2][1]), (6_000, rows[2][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gain = {}
    for size in (5_000, 1 << 20):
        got = language_model.score(docs, part_tokens=size).collect()
        assert len(got) == len(rows) and all(r.n_tokens == len((dict(rows)[r.doc_id]).split()) + 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (None, 2, 6_000)}) == 1  # equal texts
        held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 3_000]
        gain[size] = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain[5_000] > gain[1 << 20] + 0.2 and gain[5_000] > 0.4, gain


def test_class_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(k, f"a b c w{k % 7} w{k % 3} é{k}") for k in range(50)], "doc_id long, text string")
    lex = language_model.lexicon(language_model.token_table(docs))
    p = language_model.train(docs, lex)
    rows = np.tile(np.array([[1, 2, 3, 4, language_model.BUCKETS - 1]]), (language_model.HEAD_WORDS, 1))
    classes = np.exp(language_model._log_softmax(language_model._sums(p[0], rows[:1])))
    assert abs(classes.sum() - 1) < 1e-4
    inner = np.exp(language_model.head_log_probability(p[1], rows, np.arange(language_model.HEAD_WORDS)))
    assert np.allclose(inner.reshape(language_model.HEAD_CLASSES, -1).sum(1), 1, atol=1e-4)


def test_toxicity(spark, odd, monkeypatch):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(200)]
    rows, labels = list(odd[1]), []
    for k in range(100, 400):
        text = rng.choices(words, k=rng.randint(5, 150))
        bad = k % 3 == 0
        for _ in range(3 * bad):
            text.insert(rng.randrange(len(text)), rng.choice(["badone", "badtwo"]))
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    for k in range(400, 460):  # long ones: more windows than training sees, or than any training document has
        held = zlib.crc32(str(k).encode()) % 5 == 0
        text = rng.choices(words, k=20_000 if held else 4_000)
        for at in range(0, len(text) * (k % 2), 60):
            text[at] = "badone"
        rows.append((k, " ".join(text)))
        labels.append((k, k % 2))
    monkeypatch.setattr(toxicity, "STEPS", 150)
    made = spark.createDataFrame(labels + [(100, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), made).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    long = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 400]
    assert {r.doc_id % 2 for r in long} == {0, 1} and all(r.predicted == r.doc_id % 2 for r in long)
    held = [r for r in got if r.held_out and r.doc_id and 100 <= r.doc_id < 400]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.9 * len(held)
    none = toxicity.toxicity(spark.createDataFrame(rows[:5], "doc_id long, text string"), made.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_gradients_are_derivatives():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.new_params(rng).items()}
    x, y = toxicity.inputs_of(["you are a b c " * 8, "", "hello world " * 60, "z"]), np.array([1, 0, 1, 0])
    _, g = toxicity.gradients(p, x, y)
    for k in p:
        at = tuple(np.argwhere(np.abs(g[k]) >= np.abs(g[k]).max() / 2)[0])
        p[k][at] += 1e-3
        high = toxicity.gradients(p, x, y)[0]
        p[k][at] -= 2e-3
        low = toxicity.gradients(p, x, y)[0]
        p[k][at] += 1e-3
        assert abs((high - low) / 2e-3 - g[k][at]) < 1e-3 * max(1, abs(g[k][at]))


def similarity(a: str, b: str) -> float:
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (WORD.findall(t.lower()) for t in (a, b)))
    return len(x & y) / len(x | y)


def test_one_of_each_group(spark):
    rng = random.Random(5)
    base = [" ".join(f"t{rng.randrange(5_000)}" for _ in range(200)) for _ in range(20)]
    rows = list(enumerate(base))
    for k, t in enumerate(base):
        w = t.split()
        w[50] = w[120] = "new"
        rows += [(100 + k, " ".join(w)), (200 + k, t), (300 + k, " ".join(w[:100] + [f"q{rng.randrange(9_999)}" for _ in range(100)]))]
    rows += [(None, base[0]), (400, None), (401, ""), (5, base[5])]
    left = simhash.one_of_each_group(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int").repartition(3)).collect()
    assert sorted(r.doc_id for r in left) == [*range(20), *range(300, 320), 400]
    assert all(similarity(a.text or "", b.text or "") < 0.8 for a in left for b in left if a is not b)


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes = []
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(step(spark, docs, SF), f"test-{name}")
        if name != "pieces":
            assert docs.schema.simpleString() == before.schema.simpleString()
        sizes.append(docs.count())
        assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert 0 < sizes[-1] <= sizes[0] < len(texts)
    codec = PieceCodec(queries.tokenizer_file("piece_bpe_32k.model"))
    assert all(codec.model.decode(list(r.ids)) == r.decoded for r in docs.collect())
    empty = queries.table(spark, SF, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        empty = step(spark, empty, SF)
    assert empty.count() == 0
