"""Document fingerprints by winnowing, and the likeness of neighbours in an order.

Every run of ``GRAM`` code points has a rolling hash; of every ``WINDOW`` consecutive hashes the
smallest is chosen, the rightmost one if several are smallest. A chosen hash keeps its position, so
any passage of ``GRAM + WINDOW - 1`` code points that two texts share is found through a common
hash, with its place in both. A text with fewer hashes is one window, one shorter than ``GRAM`` is
a single run; an empty text has no fingerprint.

A fingerprint as text is base64 of its records, 12 bytes each: hash (8, big-endian), position (4).
Likeness is the share of distinct hashes that two fingerprints have in common (of all that either
has); two empty ones are alike (1).

:func:`neighbours` brings each document together with the next one by id without shuffling a text
twice: splitters from a bounded sample cut the order into ranges, and every range also gets the
first text of the range after it. Ids ascend, null first; rows of equal id are ordered by a hash of
the text, and rows equal in both may change places. A hot id is split by its texts, a hot pair of
id and text by a number: all its pieces but the last are followed by the text itself.

Null texts are empty. Long texts are taken in blocks of ``BLOCK`` code points that overlap, so
memory follows the longest text, not its hashes. A single document is its own next one; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abonara.llm.common import BYTE_VALUE, STEP, mix, written
from abonara.llm.shards import range_of, splitters

GRAM, WINDOW = 16, 32
BLOCK = 1 << 20
#: Size of a range of the order, and their greatest number (their keys pass the driver).
RANGE_BYTES, MAX_RANGES = 8 << 20, 1 << 14
#: Ranges that a task gets by hash on average, so that tasks are of near-equal size.
RANGES_PER_TASK = 4
FLUSH_ROWS, FLUSH_BYTES = 1000, 4 << 20

_INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))


def _powers(first: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, first, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


class Grams:
    """Rolling hashes: differences of running sums of code values times powers, turned back to the first power."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, points: np.ndarray, gram: int) -> np.ndarray:
        if len(self.up) < len(points):
            n = max(len(points), 2 * len(self.up), 4096)
            self.up, self.down = _powers(STEP, n), _powers(_INVERSE, n)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((mix(points * BYTE_VALUE[7])) * self.up[:len(points)], out=sums[1:])
        n = len(points) - gram + 1
        return mix((sums[gram:] - sums[:n]) * self.down[:n])


grams = Grams()


def _smallest(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the chosen hash of every window, ascending; of equal ones the rightmost."""
    best = np.arange(len(hashes))
    width = 1
    while width < window:
        # Runs of ``width`` joined in pairs; the last step may overlap.
        step = min(width, window - width)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        width += step
    return np.unique(best)


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and the positions (code points) where their runs begin."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    many = max(n - gram + 1, 1)
    hashes, chosen = [], []
    for first in range(0, max(many - window + 1, 1), BLOCK):
        # Windows that begin in this block.
        part = points[first:first + BLOCK + gram + window - 2].astype(np.uint64)
        values = grams(part, min(gram, len(part)))
        at = _smallest(values, min(window, len(values)))
        hashes.append(values[at])
        chosen.append(at + first)
    if len(chosen) == 1:
        return hashes[0], chosen[0]
    at, where = np.unique(np.concatenate(chosen), return_index=True)
    return np.concatenate(hashes)[where], at


_RECORD = np.dtype([("hash", ">u8"), ("position", ">u4")])


def packed(hashes: np.ndarray, positions: np.ndarray) -> str:
    records = np.zeros(len(hashes), _RECORD)
    records["hash"], records["position"] = hashes, positions
    return base64.b64encode(records.tobytes()).decode()


def unpacked(text: str) -> tuple[np.ndarray, np.ndarray]:
    records = np.frombuffer(base64.b64decode(text), _RECORD)
    return records["hash"].astype(np.uint64), records["position"].astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, and the fingerprint as lists of hashes (signed) and positions. No shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, FLUSH_ROWS):
                ids, texts = (batch.column(k)[first:first + FLUSH_ROWS] for k in range(2))
                texts = texts.to_pylist()
                found = [fingerprint(t, gram, window) for t in texts]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "hashes": pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    "positions": pa.array([p for _, p in found], pa.list_(pa.int64()))})
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("body"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, hashes array<long>, positions array<long>")


# -- the next document in an order ------------------------------------------------------------


def _key(id_col: Column, text: Column) -> Column:
    """48 characters in the order of id (null first), text hash and a number that deals equal rows."""
    digits = lambda c: F.lpad(F.hex(c.bitwiseXOR(F.lit(-2 ** 63))), 16, "0")
    salt = F.xxhash64(F.monotonically_increasing_id())
    return F.concat(F.coalesce(digits(id_col), F.lit(" " * 16)), digits(F.xxhash64(text)), digits(salt))


def _walk(gram: int, window: int):
    """Rows (range, doc_id, body, last) sorted by place: each with what follows it in its range.

    The last row of a range is the first text of the next range; it is no document of this one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, size = None, [], 0
        for batch in batches:
            for doc_id, body, last in zip(*(batch.column(k) for k in range(3))):
                doc_id, body, last = doc_id.as_py(), body.as_py(), last.as_py()
                marks = fingerprint(body, gram, window)
                if held is not None:
                    out.append(_row(*held, body, marks[0], gram, window))
                    size += len(out[-1][3]) + len(out[-1][4])
                held = None if last else (doc_id, body, marks)
                if len(out) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                    yield _batch(out)
                    out, size = [], 0
        yield _batch(out)
    return run


def _row(doc_id, body, marks, after, after_hashes, gram, window) -> tuple:
    cut = len(body) // 4
    edited = body[:len(body) - cut] + after[:cut]
    changed = fingerprint(edited, gram, window) if cut else marks
    return (doc_id, len(body), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), packed(*marks),
            packed(*changed), likeness(marks[0], changed[0]), likeness(marks[0], after_hashes))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def neighbours(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, *, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its text with the last quarter replaced by the beginning of
    the next document (after the last one: the first), and how alike the fingerprints are."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    doc_id = docs[id_col].cast("long")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("body")).withColumn("key", _key(F.col("doc_id"), F.col("body")))
    keys = written(rows.select("key", (F.octet_length("body") + 16).cast("long").alias("size")), "winnow_keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = int(min(max(total // RANGE_BYTES, 1), MAX_RANGES))
    cuts = splitters(keys, ranges)
    firsts = keys.groupBy(range_of(cuts)("key").alias("range")).agg(F.min("key").alias("first"))
    # One row per range, of which there are at most a few times MAX_RANGES.
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    whole = Window.partitionBy(F.lit(0))
    ends = firsts.select("range", F.substring(F.coalesce(F.lead("first").over(order), F.min("first").over(whole)), 1, 32).alias("next"))
    wanted = ends.select("next").distinct()
    same = rows.select(F.substring("key", 1, 32).alias("next"), "body")
    heads = same.join(F.broadcast(wanted), "next", "left_semi").groupBy("next").agg(F.first("body").alias("body"))
    sentinels = ends.join(heads, "next").select("range", F.lit("~").alias("key"), F.lit(None).cast("long").alias("doc_id"), "body",
                                                F.lit(True).alias("last"))
    placed = rows.select(range_of(cuts)("key").alias("range"), "key", "doc_id", "body", F.lit(False).alias("last"))
    dealt = placed.unionByName(sentinels).repartition(max(ranges // RANGES_PER_TASK, 1), "range").sortWithinPartitions("range", "key")
    return dealt.select("doc_id", "body", "last").mapInArrow(
        _walk(gram, window), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
