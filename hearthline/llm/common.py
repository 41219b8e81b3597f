"""Helpers shared by the document operators: shared folders, word splitting on Arrow buffers, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthline.sources.staging import new_path, shared_dir, stage  # noqa: F401  (used from here by the operators)

#: Word separators everywhere in this subpackage: space, and tab to carriage return.
BLANK = " \t\n\x0b\x0c\r"
BLANKS = r"[\x20\x09-\x0D]+"
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(key: str, modulus: int, hit: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder ``hit``; a null key does not."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(modulus)) == hit, F.lit(False))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with about ``most`` bytes in a text column (one row at least), and that column without nulls."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).fill_null("").cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), texts.slice(at, to - at)
            at = to


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array, and where each text begins (one entry more than texts)."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    return flat, ends - ends[0]


def lowered(flat: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes of UTF-8 stay."""
    return np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)


class Words:
    """Words of a run of texts: start and end of each in ``flat``, and ``first``, where each text's words begin."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        blank = (flat == 32) | ((flat >= 9) & (flat <= 13))
        opens, shuts = ~blank, ~blank
        opens[1:] &= blank[:-1] | _edges(bounds, len(flat))[1:]
        shuts[:-1] &= blank[1:] | _edges(bounds, len(flat))[1:]
        self.flat, self.blank = flat, blank
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.flat, self.starts, self.ends)


def _edges(bounds: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[bounds[bounds < n]] = True
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_STEP = 1 << 12


def _run_of_powers(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2 and so on, modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Powers below _STEP of each base and of its inverse; others are products with a power of base ** _STEP, made as they are needed.
_LOW = {b: _run_of_powers(b, _STEP) for base in _BASES for b in (base, pow(base, -1, 1 << 64))}


def _powers(base: int, at: np.ndarray, n: int) -> np.ndarray:
    """base to the power of places ``at``, all below n."""
    high = _run_of_powers(pow(base, _STEP, 1 << 64), n // _STEP + 1)
    return _LOW[base][at % _STEP] * high[at // _STEP]


def _all_powers(base: int, n: int) -> np.ndarray:
    high = _run_of_powers(pow(base, _STEP, 1 << 64), n // _STEP + 1)
    return np.multiply.outer(high, _LOW[base]).ravel()[:n]


class SpanHasher:
    """64-bit hashes of byte spans that depend on their bytes alone: two polynomials, from running sums made once for the bytes."""

    def __init__(self, flat: np.ndarray):
        self.n, self.sums = len(flat), []
        for base in _BASES:
            sums = np.zeros(len(flat) + 1, np.uint64)
            terms = flat.astype(np.uint64)
            terms += np.uint64(1)
            terms *= _all_powers(base, len(flat))
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        low, high = ((s[ends] - s[starts]) * _powers(pow(b, -1, 1 << 64), starts, self.n + 1) for b, s in zip(_BASES, self.sums))
        return mix(low ^ mix(high + (ends - starts).astype(np.uint64)))


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of spans of ``flat``. Nothing as long as the texts outlives the call."""
    return SpanHasher(flat)(starts, ends)


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows
