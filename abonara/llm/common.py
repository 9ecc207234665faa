"""Byte-level helpers shared by the operators: Arrow columns as flat bytes, words, hashes.

A text travels to Python as UTF-8 bytes (a null is an empty text). ASCII lower case and ASCII
white space are byte operations, so no text is decoded on the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abonara.session import ensure_checkpoint_dir

#: Texts are hashed together up to about this many bytes, to bound memory and stay in cache.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that are no part of a word made of ASCII letters, digits and non-ASCII characters.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[list(range(0x00, 0x30)) + list(range(0x3A, 0x61)) + list(range(0x7B, 0x80))] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
WORD_STEPS = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{name}_{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, row_col: str) -> DataFrame:
    """``docs`` with a number of each row, written once so that it stays the same."""
    return written(docs.withColumn(row_col, F.monotonically_increasing_id()), "numbered")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the id and the text as bytes (null: empty), so that other columns cannot clash."""
    body = F.coalesce(docs[text_col].cast("string").cast("binary"), F.lit("").cast("binary"))
    return docs.select(docs[id_col].alias("doc_id"), body.alias("body"), *[docs[c].alias(c) for c in more])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def n_words(text: Column) -> Column:
    """Number of runs without white space, in the JVM."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def crc(text: Column) -> Column:
    return F.crc32(text.cast("string"))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each row begins (one more at the end)."""
    column = column.cast(pa.binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes; a longer text is a range of its own."""
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_spans(data: np.ndarray, off: np.ndarray, blank: np.ndarray = SPACE):
    """(first byte, byte past the end, row) of every word; words never cross rows."""
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = off[(off > 0) & (off < len(data))]
    begins[edge] = inside[edge]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1, inside


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), STEP, np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown)
    return _powers


def word_hashes(data, start, end, inside) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data), dtype=np.int64)
    lead = np.zeros(len(data), np.int64)
    lead[start] = start
    np.maximum.accumulate(lead, out=lead)
    place -= lead
    place[~inside] = 0
    values = BYTE_VALUE[data]
    values *= powers(int((end - start).max()))[place]
    values[~inside] = 0
    total = np.add.reduceat(values, start)
    return mix(total + (end - start).astype(np.uint64))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes, as if all words were one sequence."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    last = len(words) - n + 1
    total = np.zeros(last, np.uint64)
    for k in range(n):
        total += words[k:k + last] * WORD_STEPS[k]
    return mix(total)


def row_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of n rows begins in a sorted list of row numbers (one more at the end)."""
    return np.searchsorted(rows, np.arange(n + 1))
