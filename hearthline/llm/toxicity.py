"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

A word enters as its own hashed embedding beside the mean of its hashed character trigrams. Windows of WINDOW words begin
every STRIDE words and cover the whole text, whatever its length; a document's logit is the log-sum-exp of its windows' less a
learned multiple of the logarithm of their number, so a document is toxic if some window is, and a long one not because it is long.
The network is trained in numpy on a bounded sample of labelled documents of all lengths (TRAIN_DOCS a class); of one that has more
than TRAIN_WINDOWS windows, or more than TRAIN_CHARS characters, it sees TRAIN_WINDOWS windows spread evenly over the whole text
(words cut at WORD_BYTES bytes there). Everything else covers all rows and whole texts.

Null, empty and blank texts are one empty window and get the model's score of it. Labels of a document that occur more than
once count as toxic if one says so. Without labelled documents of both classes every score is the share of toxic ones (0 if
there is none). Repeated rows give repeated results, an empty table none, other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import Words, lowered, mix, pieces, remainder, stage, utf8

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM, BUCKETS, ATTENTION = 8, 8, 16, 4096, 8
#: Bounds of the labelled sample, and of training.
TRAIN_DOCS, TRAIN_WINDOWS, TRAIN_CHARS, WORD_BYTES = 2_000, 48, 24_000, 64
STEPS, BATCH, RATE = 300, 32, 0.015
#: Part of the words that hide their own embedding in training, so that characters count, and the decay of all embeddings.
HIDE, DECAY = 0.3, 0.0005

Params = dict[str, np.ndarray]


class Inputs:
    """Windows over the distinct words of a run of texts: ``ids`` (place, window) into the types (-1: none), and each
    window's document."""

    def __init__(self, words: Words):
        keys, at = np.unique(words.hashes(), return_index=True)
        each = np.searchsorted(keys, words.hashes()) if len(keys) else np.empty(0, np.int64)
        self.shown: np.ndarray | None = None  # in training: which words show their own embedding
        self.word = (keys % np.uint64(BUCKETS)).astype(np.int64)
        starts, ends = words.starts[at], words.ends[at]
        # character trigrams of < word >, over bytes
        sizes = ends - starts
        base = np.cumsum(sizes + 2) - (sizes + 2)
        flat = np.full(int((sizes + 2).sum()), 60, np.int64)
        if len(sizes):
            flat[base + sizes + 1] = 62
            inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            flat[np.repeat(base, sizes) + 1 + inner] = words.flat[np.repeat(starts, sizes) + inner]
        grams = (flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]).astype(np.uint64) if len(flat) else np.empty(0, np.uint64)
        inside = np.ones(len(grams), bool)
        for k in (1, 2):  # those that would reach into the next word
            inside[base[1:] - k] = False
        self.chars = (mix(grams[inside]) % np.uint64(BUCKETS)).astype(np.int64)
        self.many = sizes
        self.first = np.cumsum(sizes) - sizes
        n = words.counts
        self.windows = windows = windows_of(n)
        self.doc = np.repeat(np.arange(len(n)), windows)
        nth = np.arange(len(self.doc)) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = words.first[:-1][self.doc] + nth * STRIDE
        place = begin + np.arange(WINDOW)[:, None]
        real = place < words.first[1:][self.doc]
        self.ids = np.where(real, each[np.minimum(place, max(len(each) - 1, 0))], -1) if len(each) else np.full((WINDOW, len(self.doc)), -1)


def new_params(rng: np.random.Generator) -> Params:
    d = WORD_DIM + CHAR_DIM
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    out = {"word": draw(BUCKETS, WORD_DIM, scale=0.1), "char": draw(BUCKETS, CHAR_DIM, scale=0.3)}
    for way in "fb":
        out |= {f"w{way}": draw(d, 3 * HIDDEN, scale=d**-0.5), f"u{way}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
    out |= {"attend": draw(2 * HIDDEN, ATTENTION, scale=0.3), "query": draw(ATTENTION, scale=0.5)}
    return out | {"out": draw(2 * HIDDEN, scale=0.5), "bias": np.full(1, -2, np.float32), "spread": np.ones(1, np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _types(p: Params, x: Inputs) -> np.ndarray:
    word = p["word"][x.word] * (1 - HIDE if x.shown is None else x.shown[:, None])
    mean = np.add.reduceat(p["char"][x.chars], x.first, axis=0) / x.many[:, None].astype(np.float32) if len(x.many) else np.zeros((0, CHAR_DIM), np.float32)
    # a last row of zeros stands for places without a word
    return np.concatenate([np.concatenate([word, mean], 1), np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)]).astype(np.float32)


def _run(p: Params, way: str, types: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
    """States (place, window, HIDDEN) of one direction; places without a word leave the state as it is."""
    u, h = p["u" + way], np.zeros((ids.shape[1], HIDDEN), np.float32)
    inputs = types @ p["w" + way] + p["c" + way]
    states = np.empty((*ids.shape, HIDDEN), np.float32)
    for t in range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1):
        mine, real = inputs[ids[t]], (ids[t] >= 0)[:, None]
        past = h @ u
        gates = _sigmoid(mine[:, : 2 * HIDDEN] + past[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(mine[:, 2 * HIDDEN :] + r * past[:, 2 * HIDDEN :])
        after = np.where(real, new + z * (h - new), h)
        if keep is not None:
            keep.append((t, h, z, r, new, past[:, 2 * HIDDEN :], real))
        h = states[t] = after
    return states


def forward(p: Params, x: Inputs, keep: dict | None = None) -> np.ndarray:
    """The logit of every window."""
    types = _types(p, x)
    memory = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
    states = np.concatenate([_run(p, way, types, x.ids, memory[way]) for way in "fb"], 2)
    u = np.tanh(states @ p["attend"])
    raw = np.where(x.ids >= 0, u @ p["query"], -1e9)
    weight = np.exp(raw - raw.max(0))
    weight /= weight.sum(0)
    pooled = np.einsum("tn,tnh->nh", weight, states)
    if keep is not None:
        keep.update(types=types, memory=memory, states=states, u=u, weight=weight, pooled=pooled)
    return pooled @ p["out"] + p["bias"][0]


def windows_of(n_words: np.ndarray) -> np.ndarray:
    """How many windows cover so many words."""
    return np.maximum(-(-(n_words - WINDOW) // STRIDE), 0) + 1


def pooled_logits(p: Params, logits: np.ndarray, doc: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Log-mean-exp of each document's windows seen, plus what the number of all its ``windows`` adds: with a spread of 0 that
    makes the log-sum-exp, with 1 the mean stays."""
    top = np.full(len(windows), -np.inf)
    np.maximum.at(top, doc, logits)
    seen = np.bincount(doc, minlength=len(windows))
    mean = top + np.log(np.bincount(doc, np.exp(logits - top[doc]), len(windows)) / seen)
    return mean + (1 - p["spread"][0]) * np.log(windows)


def gradients(p: Params, x: Inputs, labels: np.ndarray, doc: np.ndarray | None = None, windows: np.ndarray | None = None) -> tuple[float, Params]:
    """Mean cross-entropy over documents, and its derivative for every parameter. ``doc`` and ``windows`` give each window's
    document and how many windows a document has, where not all are among the inputs."""
    keep: dict = {}
    logits = forward(p, x, keep)
    n = len(labels)
    doc = x.doc if doc is None else doc
    seen = np.bincount(doc, minlength=n)
    windows = seen if windows is None else windows
    whole = pooled_logits(p, logits, doc, windows)
    loss = float(np.mean(np.logaddexp(0, whole) - labels * whole))
    wrong = (_sigmoid(whole) - labels) / n
    share = np.exp(logits - (whole - (1 - p["spread"][0]) * np.log(windows))[doc]) / seen[doc]
    d_logit = (wrong[doc] * share).astype(np.float32)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["out"], g["bias"] = keep["pooled"].T @ d_logit, np.array([d_logit.sum()], np.float32)
    g["spread"] = np.array([-(wrong * np.log(windows)).sum()], np.float32)
    d_pooled = d_logit[:, None] * p["out"]
    d_states = keep["weight"][:, :, None] * d_pooled
    d_weight = np.einsum("nh,tnh->tn", d_pooled, keep["states"])
    d_raw = np.where(x.ids >= 0, keep["weight"] * (d_weight - (keep["weight"] * d_weight).sum(0)), 0)
    g["query"] = np.einsum("tn,tna->a", d_raw, keep["u"])
    d_u = d_raw[:, :, None] * p["query"] * (1 - keep["u"] ** 2)
    g["attend"] = np.einsum("tnh,tna->ha", keep["states"], d_u)
    d_states = d_states + d_u @ p["attend"].T
    d_types = np.zeros_like(keep["types"])
    for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        d_h = np.zeros_like(d_states[0, :, :HIDDEN])
        d_inputs = np.zeros((len(d_types), 3 * HIDDEN), np.float32)
        for t, h, z, r, new, past, real in reversed(keep["memory"][way]):
            d_h = d_h + d_states[t, :, part]
            live = np.where(real, d_h, 0)
            d_new = live * (1 - z) * (1 - new**2)
            d_z = live * (h - new) * z * (1 - z)
            d_r = d_new * past * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_new], 1)
            d_past = np.concatenate([d_z, d_r, d_new * r], 1)
            g["u" + way] += h.T @ d_past
            d_h = np.where(real, live * z, d_h) + d_past @ p["u" + way].T
            np.add.at(d_inputs, x.ids[t], d_in)
        d_inputs[-1] = 0
        g["w" + way] = keep["types"].T @ d_inputs
        g["c" + way] = d_inputs.sum(0)
        d_types += d_inputs @ p["w" + way].T
    d_types = d_types[:-1]
    np.add.at(g["word"], x.word, d_types[:, :WORD_DIM] * (1 - HIDE if x.shown is None else x.shown[:, None]))
    np.add.at(g["char"], x.chars, np.repeat(d_types[:, WORD_DIM:] / x.many[:, None], x.many, axis=0))
    return loss, g


def plain(flat: np.ndarray) -> np.ndarray:
    """Lower-case bytes with ASCII signs as blanks, so that a word is the same beside a sign."""
    sign = ((flat > 32) & (flat < 48)) | ((flat > 57) & (flat < 65)) | ((flat > 90) & (flat < 97)) | ((flat > 122) & (flat < 127))
    return np.where(sign, 32, lowered(flat)).astype(np.uint8)


def inputs_of(texts: list[str]) -> Inputs:
    flat, bounds = utf8(pa.array(texts, pa.large_string()))
    return Inputs(Words(plain(flat), bounds))


def seeded(p: Params, texts: list[list[str]], labels: np.ndarray) -> None:
    """Begins the first place of every embedding with how far the documents of a bucket lean to toxic, in deviations."""
    seen = {kind: np.zeros((2, BUCKETS)) for kind in ("word", "char")}
    for parts, label in zip(texts, labels):
        x = inputs_of(parts)
        seen["word"][int(label), np.unique(x.word)] += 1
        seen["char"][int(label), np.unique(x.chars)] += 1
    for kind, counts in seen.items():
        expected = counts.sum(0) * labels.mean()
        p[kind][:, 0] = np.clip((counts[1] - expected) / np.sqrt(expected + 1), -4, 4) / 2


def train(texts: list[list[str]], labels: np.ndarray, windows: np.ndarray, seed: int = 7, steps: int = STEPS) -> Params:
    """Adam over batches with as many documents of either class; a document is a list of parts, a whole text or single windows of
    one that has so many ``windows``."""
    rng = np.random.default_rng(seed)
    p = new_params(rng)
    seeded(p, texts, labels)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        x = inputs_of([part for i in chosen for part in texts[i]])
        doc = np.repeat(np.arange(len(chosen)), [len(texts[i]) for i in chosen])[x.doc]
        x.shown = (rng.random(len(x.word)) >= HIDE).astype(np.float32)
        _, g = gradients(p, x, labels[chosen], doc, windows[chosen])
        norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k in p:
            grad = g[k] / max(1, norm)
            m[k] += 0.1 * (grad - m[k])
            v[k] += 0.01 * (grad**2 - v[k])
            if k in ("word", "char"):
                p[k] *= np.float32(1 - DECAY)
            p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def held_out() -> F.Column:
    return remainder("doc_id", 5, 0)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Params | None, float]:
    """The network, or None without documents of both classes, and the share of toxic ones among the labelled rows."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    share = known.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
    sample = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * TRAIN_DOCS) for c in (0, 1)]
    few = F.broadcast(sample[0].unionByName(sample[1]))  # twice as many labels as documents wanted, as some have no document
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(few, "doc_id")
    key = [F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t")]
    shown = T.StructType.fromDDL("label int, h long, t long, parts array<string>, windows long")
    parts = stage(found.select(F.col("label").cast("int").alias("label"), *key, "text").mapInArrow(_shown, shown), "toxic-sample")
    rows = [r for c in (0, 1) for r in parts.filter(F.col("label") == c).orderBy("h", "t").limit(TRAIN_DOCS).collect()]
    y, windows = (np.array([r[c] for r in rows]) for c in ("label", "windows"))
    return (train([r.parts for r in rows], y, windows) if len(set(y.tolist())) == 2 else None), float(share)


def _shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What training sees of each document: its text, or windows spread evenly over a long one, and how many it has."""
    for batch, texts in pieces(batches, "text", 1 << 20):
        flat, bounds = utf8(texts)
        words = Words(plain(flat), bounds)
        counts, parts = windows_of(words.counts), []
        for i, text in enumerate(texts.to_pylist()):
            if counts[i] <= TRAIN_WINDOWS and len(text) <= TRAIN_CHARS:
                parts.append([text])
                continue
            at = np.unique(np.linspace(0, counts[i] - 1, min(counts[i], TRAIN_WINDOWS)).astype(int)) * STRIDE + words.first[i]
            spans = [range(k, min(k + WINDOW, words.first[i + 1])) for k in at]
            cut = lambda j: words.flat[words.starts[j] : min(words.ends[j], words.starts[j] + WORD_BYTES)].tobytes().decode("utf-8", "ignore")
            parts.append([" ".join(map(cut, span)) for span in spans])
        columns = [batch.column(c) for c in ("label", "h", "t")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.list_(pa.string())), pa.array(counts.astype(np.int64))], ["label", "h", "t", "parts", "windows"])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    p, share = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(p)  # of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch, texts in pieces(batches, "text", 1 << 20):
            if p is None:
                scores = np.full(len(texts), share)
            else:
                flat, bounds = utf8(texts)
                x = Inputs(Words(plain(flat), bounds))
                scores = _sigmoid(pooled_logits(p, forward(p, x).astype(np.float64), x.doc, x.windows))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(score, schema)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
