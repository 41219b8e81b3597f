"""The registered queries of the document operators, with the SQL that each must equal where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthline.llm import language_model
from hearthline.llm.common import new_path, table
from hearthline.llm.decontaminate import contaminated
from hearthline.llm.html_extract import extract_pages
from hearthline.llm.line_dedup import line_dedup
from hearthline.llm.line_sql import OP5
from hearthline.llm.periodic_runs import periodic_runs
from hearthline.llm.piece_codec import encode_decode
from hearthline.llm.prefix_trie import prefix_trie, turn_numbers
from hearthline.llm.quality_rules import quality_rules
from hearthline.llm.quality_sql import OP8
from hearthline.llm.sharding import histogram_shards
from hearthline.llm.simhash import near_duplicates
from hearthline.llm.suffix_dedup import suffix_dedup
from hearthline.llm.token_counts import token_counts
from hearthline.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op5_line_dedup": OP5, "op8_quality_rules": OP8}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document that copies a benchmark item, whole or edited."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, items, ["doc_id"]).withColumnRenamed("item", "item_id")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose 3-word fingerprints link at 3 or fewer differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, words64=1, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses when only the first of equal or linked lines stays, and a digest of what is left."""
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "n_links", F.sha2("cleaned", 256).alias("kept_sha256")
    )


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents under 400-byte strings that also begin elsewhere, removed."""
    return suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes, by histogram sort on the text hash."""
    return histogram_shards(table(spark, sf_dir, "documents")).withColumns({
        "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int"),
    })


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars"
    )


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a digest cache that begins empty, in the shared folder."""
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), new_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def planted_order(batch: pa.RecordBatch, counts: np.ndarray) -> dict[int, np.ndarray]:
    """The word order of texts whose end repeats, by the crc32 of the id."""
    out = {}
    for row, (key, n) in enumerate(zip(batch.column("id").to_pylist(), counts.tolist())):
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            order = np.arange(n)
            order[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
            out[row] = order
    return out


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated phrases of all documents, a tenth of which get a repeated end, and digests of runs and of what is left."""
    found = periodic_runs(table(spark, sf_dir, "documents"), order=planted_order, full=False)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that take their first turns from the first conversation of their hundred."""
    given = table(spark, sf_dir, "conversations")
    own = turn_numbers(given)
    c = F.col("conv_id")
    convs = given.where(c.isNotNull()).select(c.cast("long").alias("conv_id")).distinct()
    convs = convs.withColumns({"h": F.crc32(c.cast("string")) % 6, "base": c - c % 100})
    heads = own.where((c % 100 == 0) & (F.col("number") <= 5)).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").where("number <= h").select("conv_id", "number", "role", "text")
    found = heads.groupBy("base").agg(F.count("*").alias("n_base"))
    taken = convs.join(found, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    rest = own.join(taken, "conv_id").where("number > h").select("conv_id", (F.col("number") - F.col("h") + F.col("k")).alias("number"), "role", "text")
    return prefix_trie(given, first.unionByName(rest))


@query
def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))
