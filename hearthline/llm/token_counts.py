"""Token counts with a digest cache: counts are stored by content digest and tokenizer version, only misses are encoded.

The normal form of a text is its UTF-8 bytes (null: empty), as any stronger form would change counts. Repeated texts are
encoded once, repeated rows give repeated results, an empty table appends nothing.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hearthline.llm.common import pieces, text_or_empty

CACHE = "tokenizer string, digest string, n_tokens long"


def version_digest(path: str) -> str:
    """A digest of the vocabulary file and of the library's version: counts of another version are never reused."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


#: Distinct pre-tokens whose counts a task keeps; beyond that it starts anew.
KEPT = 300_000
#: Fixed pattern of byte-level BPE: how it parts a text before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class all pattern engines agree; texts with others go to the tokenizer whole.
PLAIN = r"[\t\n\r\x20-\x7e\u00a1-\u024f\u0400-\u045f]*"


class Counter:
    """Counts by the tokenizers library. Merges never cross pre-tokens, so each distinct one of plain texts is encoded once
    and its count kept; texts with a special token's string or with other characters are encoded whole."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_level = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tokenizer.normalizer is None
        self.parted = byte_level and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.part, self.plain = regex.compile(PATTERN).findall, re.compile(PLAIN).fullmatch
        self.kept: dict[str, int] = {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        plain = [self.parted and bool(self.plain(t)) and not any(s in t for s in self.special) for t in texts]
        parts = [self.part(t) if ok else [] for t, ok in zip(texts, plain)]
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = list({p for ps in parts for p in ps if p not in self.kept})
        self.kept.update(zip(new, self.whole(new)))
        rest = iter(self.whole([t for t, ok in zip(texts, plain) if not ok]))
        return [sum(map(self.kept.__getitem__, ps)) if ok else next(rest) for ps, ok in zip(parts, plain)]


@lru_cache(2)
def counter_of(path: str) -> Counter:
    """One for all tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Counter(path)


def encode_counts(rows: DataFrame, path: str) -> DataFrame:
    """digest and n_tokens of every row (digest, text), by the tokenizers library in Arrow batches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch, texts in pieces(batches, "text", 1 << 20):
            counts = pa.array(counter.counts(texts.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), counts], ["digest", "n_tokens"])

    return rows.select("digest", "text").mapInArrow(count, "digest string, n_tokens long")


def token_counts(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row. ``cache`` is a Parquet folder that all executors share; counts that it lacks
    are appended to it. The driver writes, so a lost executor leaves no half batch behind.

    Rows of one digest are reduced to one in every partition before they are exchanged, so a group of copies stays small.
    """
    spark = docs.sparkSession
    version = version_digest(path)
    keyed = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest")
    )
    empty = spark.createDataFrame([], CACHE)
    empty.write.mode("append").parquet(cache)
    known = lambda: (
        spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )
    texts = keyed.select("digest", "text").dropDuplicates(["digest"]).join(known().select("digest"), "digest", "left_anti")
    encode_counts(texts, path).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return keyed.select("doc_id", "n_bytes", "digest").join(known(), "digest").select("doc_id", "n_bytes", "n_tokens")
