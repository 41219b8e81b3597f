"""Hashed maximum-entropy language model: n-gram and skip features, a class-factored softmax, distributed gradient updates.

A token is a word, or the one end that follows a text. The model's parameters are parted by the word before: each part holds about
PART_TOKENS tokens that follow the same words, with BUCKETS hashed feature rows and a head of HEAD_WORDS tokens of its own, so
rows and heads grow with the training tokens. The tokens go to the parts in packed runs; the task of a part takes gradient
steps over its training tokens, each used once, then scores all its tokens, and the sums go back to their documents. A word whose
tokens fill more than a quarter of a part is shared among parts, by text and place. Token counts cover all training documents.

The probability of a token is P(class | features) times P(token | class, features). The HEAD_WORDS tokens that are most frequent
in the part form classes of CLASS_WORDS each, by rank; inside such a class a second softmax over the same features chooses the
token. The rest of the COMMON_TOKENS form classes by the size of their count and by whether they hold other characters than
ASCII, and all rarer tokens two more; inside such a class a token has the share (count + 1) of its class. A token that training
never saw is one of the rarer ones: together such tokens have the mass of those seen once (Good-Turing), spread evenly over as
many as the counts of tokens seen once and twice let expect (Chao's estimate).

Null, empty and blank texts are one end. Repeated rows are repeated evidence and give repeated results; rows with a null id
are training rows; an empty table gives none; other columns are not used. The order of the steps, and with it a score's last
digits, depends on how the input is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from hearthline.llm.common import Words, lowered, mix, pieces, remainder, stage, utf8

CLASS_WORDS, HEAD_CLASSES = 32, 24
HEAD_WORDS = CLASS_WORDS * HEAD_CLASSES
#: Tokens whose counts travel with the tasks (17 bytes each); the counts of all others are joined.
COMMON_TOKENS = 200_000
#: Feature rows and training tokens of a part.
BUCKETS, PART_TOKENS = 2048, 1 << 21
RATE, BATCH = 0.8, 8192
#: Tokens that a task collects before it packs them for the parts.
RUN_TOKENS = 1 << 21
#: What the corpus' shares of the classes weigh, in tokens, beside a part's own counts.
PRIOR = 32
END = np.uint64(0x454E4421)
LOG10 = np.log(10)


def held_out() -> F.Column:
    return remainder("doc_id", 7, 2)


class Tokens:
    """The tokens of a run of texts in order, each text's end last: hash, byte span (empty for an end) and text."""

    def __init__(self, texts: pa.Array):
        flat, bounds = utf8(texts)
        self.flat = lowered(flat)
        words = Words(self.flat, bounds)
        self.many = words.counts + 1
        self.last = np.cumsum(self.many) - 1
        n = int(self.many.sum())
        inner = np.ones(n, bool)
        inner[self.last] = False
        self.doc = np.repeat(np.arange(len(self.many)), self.many)
        self.hash, self.start, self.stop = np.full(n, END), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.hash[inner] = words.hashes() | np.uint64(1 << 63)  # never an end's
        self.start[inner], self.stop[inner] = words.starts, words.ends
        self.place = np.arange(n) - (self.last - self.many + 1)[self.doc]

    def features(self) -> np.ndarray:
        """Hashed rows for each token: the word before, the two before, the one before that alone (a skip), the skip pair of
        the first and third before, and a constant."""
        back = []
        for k in (1, 2, 3):
            h = np.zeros_like(self.hash)
            ok = self.place >= k
            h[ok] = self.hash[np.flatnonzero(ok) - k]
            back.append(h)
        one, two, three = back
        kinds = (one, mix(one) + two, two ^ np.uint64(0x5851F42D), mix(one) + mix(three))
        rows = [mix(f + np.uint64(0x9E37 * (k + 1))) % np.uint64(BUCKETS - 1) for k, f in enumerate(kinds)]
        return np.stack([*rows, np.full_like(rows[0], BUCKETS - 1)], 1).astype(np.int64)


def token_table(docs: DataFrame) -> DataFrame:
    """h (64-bit hash, which stands for the token), n, wide (holds other than ASCII) of all tokens of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches, "text"):
            t = Tokens(texts)
            h, first, n = np.unique(t.hash, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": h.view(np.int64), "n": n, "wide": _wide(t)[first]})

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "h long, n long, wide boolean")
    return rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("wide").alias("wide"))


def _wide(t: Tokens) -> np.ndarray:
    high = np.concatenate([[0], np.cumsum(t.flat >= 128)])
    return high[t.stop] > high[t.start]


class Lexicon:
    """The common tokens, which all occur twice at least, numbered by frequency; -1 and -2 (wide) stand for all rarer ones, seen or
    not."""

    def __init__(self, top: list, total: int, rest: dict[bool, int], once: dict[bool, int], twice: dict[bool, int]):
        self.total = total
        hashes = np.array([r.h for r in top], np.int64).view(np.uint64)
        self.number = np.argsort(hashes)
        self.common = hashes[self.number]
        self.count, self.wide = np.array([r.n for r in top], np.int64), np.array([r.wide for r in top], bool)
        #: What all rarer tokens weigh, with those never seen, and how many those may be.
        unseen = {w: max(once.get(w, 0), 1) for w in (False, True)}
        many = {w: max(once.get(w, 0) * (once.get(w, 0) - 1) / 2 / (twice.get(w, 0) + 1), 1) for w in (False, True)}
        self.unseen = np.log([unseen[w] / many[w] for w in (False, True)])
        self.rarer = np.array([rest.get(w, 0) + unseen[w] for w in (False, True)], float)

    def look_up(self, t: Tokens) -> np.ndarray:
        """The number of each token."""
        rarer = -1 - _wide(t).astype(np.int64)
        if not len(self.common):
            return rarer
        at = np.minimum(np.searchsorted(self.common, t.hash), len(self.common) - 1)
        return np.where(self.common[at] == t.hash, self.number[at], rarer)


class Classes:
    """The classes of a part, from how often it has each common token, and last the rarer wide and other ones, in training. Tail
    classes are (bits of the count, wide); bits 0 stands for all rarer tokens. ``cls``, ``rank`` (-1: tail) and ``share`` (ln of a
    tail token's share of its class; of a rarer one's, but for its count) are by the token's number."""

    def __init__(self, lex: Lexicon, seen: np.ndarray):
        n = len(lex.count)
        weight = np.concatenate([lex.count + 1, lex.rarer[::-1]])
        head = np.argsort(-seen[:n], kind="stable")[:HEAD_WORDS]
        head = head[seen[head] > 0]
        self.rank = np.full(n + 2, -1)
        self.rank[head] = np.arange(len(head))
        bits = np.floor(np.log2(np.maximum(lex.count, 1) + 0.5)).astype(np.int64) + 1
        kind = np.concatenate([2 * bits + lex.wide, [1, 0]])
        tail = self.rank < 0
        mass = np.bincount(kind[tail], weight[tail], 130)
        place = HEAD_CLASSES + np.cumsum(mass > 0) - 1
        self.count = HEAD_CLASSES + int((mass > 0).sum())
        self.cls = np.where(tail, place[kind], self.rank // CLASS_WORDS)
        self.share = np.where(tail, np.log(weight) - np.log(np.where(tail, mass[kind], 1)), 0)
        self.share[n:] = -np.log(mass[[1, 0]])
        corpus = np.bincount(self.cls, weight, self.count)
        self.start = np.log(np.maximum(np.bincount(self.cls, seen, self.count) + PRIOR * corpus / corpus.sum(), 1e-3) / (seen.sum() + PRIOR))
        self.head = np.full(HEAD_WORDS, -30.0)
        self.head[: len(head)] = np.log(seen[head])


def lexicon(counts: DataFrame) -> Lexicon:
    top = counts.filter("n > 1").orderBy(F.desc("n"), "h").limit(COMMON_TOKENS).collect()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sums = F.sum(F.col("n") + 1).alias("mass"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")
    by_kind = counts.groupBy("wide").agg(*sums).collect()
    rest = {r.wide: r.mass - sum(x.n + 1 for x in top if x.wide == r.wide) for r in by_kind}
    return Lexicon(top, int(total), rest, {r.wide: r.once for r in by_kind}, {r.wide: r.twice for r in by_kind})


Params = tuple[np.ndarray, np.ndarray]


def new_params(classes: Classes) -> Params:
    """Weights of classes (a row for each bucket) and of head tokens: zero, but the constant's row gives the counts' shares."""
    p = np.zeros((BUCKETS, classes.count), np.float32), np.zeros((BUCKETS, HEAD_WORDS), np.float32)
    p[0][-1], p[1][-1] = classes.start, classes.head
    return p


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(1, keepdims=True)
    return x - np.log(_row_sums(np.exp(x)))


def _row_sums(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij->i", x)[:, None]


def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log softmax of one column in each row."""
    x -= x.max(1, keepdims=True)
    return x[np.arange(len(x)), chosen] - np.log(_row_sums(np.exp(x))[:, 0])


def _sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the feature rows of each token."""
    out = table.take(rows[:, 0], 0)
    for k in range(1, rows.shape[1]):
        out += table.take(rows[:, k], 0)
    return out


def head_log_probability(tokens: np.ndarray, rows: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """ln P(token | class, features) of head tokens, 0 for others."""
    out = np.zeros(len(rows))
    head = np.flatnonzero(rank >= 0)
    if len(head):
        by_class = tokens.reshape(BUCKETS * HEAD_CLASSES, CLASS_WORDS)
        at = rows[head] * HEAD_CLASSES + (rank[head] // CLASS_WORDS)[:, None]
        out[head] = _log_chosen(_sums(by_class, at), rank[head] % CLASS_WORDS)
    return out


def _step(table: np.ndarray, square: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One gradient step of a softmax over the summed feature rows; steps shrink where gradients were large (Adagrad)."""
    grad = _sums(table, rows)
    grad -= grad.max(1, keepdims=True)
    np.exp(grad, out=grad)
    grad /= _row_sums(grad)
    grad[np.arange(len(rows)), target] -= 1
    flat = rows.reshape(-1)
    if len(table) <= 1 << 16:
        flat = flat.astype(np.uint16)  # sorted by radix
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    keys = ordered[begins]
    total = np.add.reduceat(grad.T.copy().take(order // rows.shape[1], 1), begins, axis=1).T.copy()
    square[keys] += (total**2).sum(1)
    table[keys] -= RATE * total / np.sqrt(square[keys] + 1)[:, None]


def gradient_steps(p: Params, rows: np.ndarray, cls: np.ndarray, rank: np.ndarray, squares: tuple[np.ndarray, np.ndarray]) -> None:
    batch = max(BATCH // 128, min(BATCH, len(rows) // 16))  # little text: as many steps, from fewer tokens each
    for a in range(0, len(rows), batch):
        some, c, r = rows[a : a + batch], cls[a : a + batch], rank[a : a + batch]
        _step(p[0], squares[0], some, c)
        head = np.flatnonzero(r >= 0)
        if len(head):
            by_class = p[1].reshape(BUCKETS * HEAD_CLASSES, CLASS_WORDS)
            _step(by_class, squares[1], some[head] * HEAD_CLASSES + (r[head] // CLASS_WORDS)[:, None], r[head] % CLASS_WORDS)


def _packed(*columns: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns), "zstd", asbytes=True)


def _unpacked(data: pa.Scalar, n: int, *kinds: type) -> list[np.ndarray]:
    """The columns of n entries that were packed."""
    sizes = [n * np.dtype(k).itemsize for k in kinds]
    flat = pa.decompress(data.as_buffer(), sum(sizes), "zstd")
    return [np.frombuffer(flat, k, n, at) for k, at in zip(kinds, np.cumsum([0, *sizes[:-1]]).tolist())]


#: A packed token: its document's number in the run times two and whether that is held out, as steps; its number; its feature rows.
TOKEN = (np.int32, np.int32, *[np.uint16] * 4)
DOC = "held_out boolean, n_tokens long, n_known long, base double, h array<bigint>, unseen array<float>, row long"


def _schema(docs: DataFrame) -> T.StructType:
    return T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(f"{DOC}, run long, part long, size long, data binary").fields])


def dealt(marked: DataFrame, lex: Lexicon, parts: int, unit: float = 0.0, part_tokens: int = PART_TOKENS) -> DataFrame:
    """A row for each document (part below 0), with what its common tokens give to the base and lists of its other tokens, and a
    row for each run of documents and part, with the run's tokens of that part."""
    shared = marked.sparkSession.sparkContext.broadcast(lex)  # of fixed size
    schema = _schema(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        shares = np.append(1 + lex.count * 4 // part_tokens, [1, 1])  # parts that the tokens after a word go to
        of_end = np.flatnonzero(lex.common == END)
        at_start = shares[lex.number[of_end[0]]] if len(of_end) else 1
        first = TaskContext.get().partitionId() << 33
        next_row, some, held = first, [], 0
        for batch, texts in pieces(batches, "text", 1 << 20):
            t = Tokens(texts)
            number, rows, n = lex.look_up(t), t.features(), len(texts)
            known = number >= 0
            count = np.append(lex.count, [0, 0])[number]
            base = np.where(known, np.log(count + 1) - unit, 0)
            rare = np.flatnonzero(~known)
            wide = (number[rare] == -2).astype(np.int64)
            lists = [_per_doc(t.doc[rare], n, x) for x in (t.hash[rare].view(np.int64), lex.unseen[wide].astype(np.float32))]
            sums = [np.bincount(t.doc, x, n) for x in (known, base)]
            out = [
                batch.column("doc_id"), batch.column("held_out"), pa.array(t.many), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]),
                *lists, pa.array(np.arange(n) + next_row), pa.array(np.full(n, first)), pa.array(np.full(n, -1 - first)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(out, schema.names)
            kinds = [x.type for x in out[:-4]]
            part = np.zeros(len(number), np.uint32)
            if parts > 1:
                begin = t.place == 0
                before, after = np.roll(t.hash, 1), shares[np.roll(number, 1)]
                before[begin], after[begin] = 0, at_start
                text = np.add.reduceat(t.hash, t.last - t.many + 1)
                nth = mix(text[t.doc] + t.place.astype(np.uint64)) % after.astype(np.uint64)
                part = (mix(before + mix(nth)) % np.uint64(parts)).astype(np.uint32)
            code = 2 * (t.doc + next_row - first) + np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)[t.doc]
            some.append((part, code.astype(np.int32), number.astype(np.int32), rows[:, :4].astype(np.uint16)))
            next_row, held = next_row + n, held + len(number)
            if held >= RUN_TOKENS:
                yield packed(some, first, kinds)
                first, some, held = next_row, [], 0
        if held:
            yield packed(some, first, kinds)

    def packed(some: list[tuple], first: int, kinds: list[pa.DataType]) -> pa.RecordBatch:
        part, code, number, rows = (np.concatenate(x) for x in zip(*some))
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        part, code, number, rows = part[order], code[order], number[order], rows[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        datas = [_packed(np.diff(code[a:b], prepend=np.int32(0)), number[a:b], *rows[a:b].T) for a, b in zip(cuts[:-1], cuts[1:])]
        n = len(datas)
        return pa.RecordBatch.from_arrays(
            [*(pa.nulls(n, k) for k in kinds), pa.array(np.full(n, first)), pa.array(part[cuts[:-1]].astype(np.int64)), pa.array(np.diff(cuts)), pa.array(datas, pa.binary())], schema.names
        )

    return marked.mapInArrow(run, schema)


def fitted(lex: Lexicon, runs: list[tuple[pa.Scalar, int]]) -> tuple[Classes, Params]:
    """The classes of a part, and its parameters after gradient steps over its training tokens, run by run."""
    seen = np.zeros(len(lex.count) + 2)
    for data, n in runs:
        code, number, *_ = _unpacked(data, n, *TOKEN)
        number = number[np.cumsum(code) % 2 == 0]
        seen += np.bincount(np.where(number < 0, number + len(seen), number), minlength=len(seen))
    classes = Classes(lex, seen)
    p = new_params(classes)
    squares = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS * HEAD_CLASSES, np.float32)
    for data, n in runs:
        code, number, *rows = _unpacked(data, n, *TOKEN)
        mine = np.cumsum(code) % 2 == 0
        number = number[mine]
        gradient_steps(p, _with_constant(rows, mine), classes.cls[number], classes.rank[number], squares)
    return classes, p


def _with_constant(rows: list[np.ndarray], some: np.ndarray | slice = slice(None)) -> np.ndarray:
    return np.stack([*(r[some].astype(np.int64) for r in rows), np.full(len(rows[0][some]), BUCKETS - 1)], 1)


def values(classes: Classes, p: Params, number: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """ln of the probability of each token; of a rarer one, but for its count."""
    out = classes.share[number]
    for a in range(0, len(rows), BATCH):
        s = slice(a, a + BATCH)
        out[s] += _log_chosen(_sums(p[0], rows[s]), classes.cls[number[s]]) + head_log_probability(p[1], rows[s], classes.rank[number[s]])
    return out


def train(docs: DataFrame, lex: Lexicon) -> Params:
    """The parameters of a part that holds all tokens of the documents, which must be few enough for one."""
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(False).alias("held_out"))
    found = dealt(marked, lex, 1).filter("part = 0").orderBy("run").select("data", "size").collect()
    return fitted(lex, [(pa.scalar(bytes(r.data), pa.binary()), r.size) for r in found])[1]


def score(docs: DataFrame, part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    counts = stage(token_table(marked.filter(~F.col("held_out"))), "token-counts")
    lex = lexicon(counts)
    unit = np.log(lex.total + counts.count() + 1)
    parts = -(-lex.total // part_tokens) or 1
    shared = spark.sparkContext.broadcast(lex)  # of fixed size
    schema = _schema(marked)
    names = schema.names

    # the runs of a part: trained on, then scored; a run's documents pass as they are
    def fit(key: tuple, runs: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return runs
        lex = shared.value
        runs = runs.sort_by("run").combine_chunks()
        blobs = list(zip(runs.column("data"), runs.column("size").to_pylist()))
        classes, p = fitted(lex, blobs)
        sizes, datas = [], []
        for data, n in blobs:
            code, number, *rows = _unpacked(data, n, *TOKEN)
            doc = np.cumsum(code) // 2
            begins = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            sums = np.add.reduceat(values(classes, p, number, _with_constant(rows)), begins)
            sizes.append(len(begins))
            datas.append(_packed(np.diff(doc[begins], prepend=0).astype(np.int32), sums.astype(np.float32)))
        return runs.set_column(names.index("size"), "size", pa.array(sizes, pa.int64())).set_column(names.index("data"), "data", pa.array(datas, pa.binary()))

    # the sums of a run's documents over all parts
    def add(key: tuple, sums: pa.Table) -> pa.Table:
        sums = sums.sort_by("part")
        found = [_unpacked(data, n, np.int32, np.float32) for data, n in zip(sums.column("data"), sums.column("size").to_pylist())]
        total = np.bincount(np.concatenate([np.cumsum(d) for d, _ in found]), np.concatenate([v for _, v in found]).astype(float))
        return pa.table({"row": np.arange(len(total)) + key[0].as_py(), "value": total})

    # as many tasks as parts, so that the documents of no run and the tokens of few parts meet in one
    tokens = dealt(marked, lex, parts, unit, part_tokens).repartition(max(parts, 8), "part")
    scored = stage(tokens.groupBy("part").applyInArrow(fit, schema), "scored-tokens")
    heads = scored.filter("part >= 0").select("run", "part", "size", "data").groupBy("run").applyInArrow(add, "row long, value double")
    scored = scored.filter("part < 0")
    rare = scored.select("row", F.explode(F.arrays_zip("h", "unseen")).alias("x")).select("row", "x.*")
    seen = F.log(F.col("n") + 1)
    # a rarer token's share is (count + 1), or that of a token never seen
    found = rare.join(counts.select("h", "n"), "h", "left").select(
        "row", (F.coalesce(seen, F.lit(0.0)) - float(unit)).alias("b"), F.coalesce(seen, F.col("unseen").cast("double")).alias("v"), F.col("n").isNotNull().cast("long").alias("k")
    )
    sums = found.unionByName(heads.select("row", F.lit(0.0).alias("b"), F.col("value").alias("v"), F.lit(0).cast("long").alias("k")))
    sums = sums.groupBy("row").agg(F.sum("b").alias("b"), F.sum("v").alias("v"), F.sum("k").alias("k"))
    out = scored.select("doc_id", "held_out", "n_tokens", "n_known", "base", "row").join(sums, "row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("k")).alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        ((F.col("base") + F.col("b")) / LOG10).alias("base_score"), (F.col("v") / LOG10).alias("score"),
    )


def _per_doc(doc: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    """Values, which are in the order of their documents, as one list for each document."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), pa.array(values))
