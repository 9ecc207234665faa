"""Suffix-array dedup: a depth-limited radix sort of suffixes, most significant digit first.

Only the first ``length`` bytes of a suffix count; suffixes that are equal to that depth are the
repeated windows. Three passes refine the order, and whatever is alone in its group leaves:

1. First digit: the anchor of the window, the ``GRAM`` bytes of smallest hash among all those
   inside it (leftmost on ties). It depends on the window alone, so equal windows share it at the
   same distance. Neighbouring suffixes with one anchor go as one run, about 140 bytes of starts.
2. Second digit: the bytes that all windows of an aligned block of ``BLOCK`` starts share. Blocks
   whose whole extent (all their windows) equals that of another block are repeated altogether.
3. Last digit: each single window of the blocks that share the second digit with different
   extents; one block stands for all those of equal extent.

So the work is sorted out run by run: no pairs are built, groups of copies are counted with
map-side partial sums, and each pass sees only what the pass before could not separate. Windows
and blocks are equal when two hashes are, 128 bits together: that of the second digit, which equal
windows always share, and that of all their bytes.

The texts are written once, bucketed by row, and every later pass meets them there without moving
them again; the table is dropped when the result is written. Nulls and texts shorter than the window keep all bytes. Repeated rows are copies and
lose what they share, each. Null ids keep their row. An empty table gives an empty result; other
columns are not read. Very long texts give more runs, which are separate rows. The digits are anchors
and blocks rather than single bytes, so that a window is not shuffled once per byte.
"""

from __future__ import annotations

import hashlib
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import BYTE_VALUE, STEP, flat, mix, powers, texts, written

LENGTH = 400
GRAM = 128
BLOCK = 32
#: Bytes hashed together; positions inside such a piece fit the low bits of a packed value.
PIECE = 1 << 20
_LOW = np.uint64((1 << 24) - 1)
_INVERSE = np.uint64(pow(int(STEP), -1, 2**64))
_inverse = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        grown = np.full(n, _INVERSE, np.uint64)
        grown[0] = 1
        _inverse = np.cumprod(grown)
    return _inverse


def _prefix(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(len(data))[:len(data)], out=total[1:])
    return total


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for many short ranges, piece by piece."""
    out = np.zeros(len(start), np.uint64)
    order = np.argsort(start, kind="stable")
    sorted_start = start[order]
    for piece in range(0, len(data), PIECE):
        a, b = np.searchsorted(sorted_start, [piece, piece + PIECE])
        if a == b:
            continue
        pick = order[a:b]
        total = _prefix(data[piece:int(end[pick].max())])
        s, e = start[pick] - piece, end[pick] - piece
        out[pick] = mix((total[e] - total[s]) * _inverse_powers(PIECE)[s] + (e - s).astype(np.uint64))
    return out


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of window starts with one anchor: (row, anchor, first start, last start, hash of the anchor)."""
    width = length - gram + 1
    found = []
    for piece in range(0, len(data) - length + 1, PIECE):
        part = data[piece:piece + PIECE + length]
        total = _prefix(part)
        n = len(part) - gram + 1
        value = mix((total[gram:] - total[:n]) * _inverse_powers(PIECE + length)[:n])
        packed = (value & ~_LOW) | np.arange(n, dtype=np.uint64)
        grid = np.full(-(-n // width) * width, 2**64 - 1, np.uint64)
        grid[:n] = packed
        grid = grid.reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        many = min(n - width + 1, PIECE)
        least = np.minimum(behind[:many], ahead[width - 1:width - 1 + many])
        found.append((least & _LOW).astype(np.int64) + piece)
    if not found:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    place = np.concatenate(found)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(place)]
    start = np.arange(len(place))
    valid = start + length <= off[row + 1]
    place, row, start = place[valid], row[valid], start[valid]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return row[first], at, start[first], start[last], range_hashes(data, at, at + gram)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _first_pass(length: int, gram: int):
    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("body"))
            row, at, low, high, key = anchors(data, off, length, gram)
            base = off[row]
            yield pa.RecordBatch.from_arrays(
                [_signed(key), batch.column("row_id").take(pa.array(row)), pa.array(at - base), pa.array(low - base),
                 pa.array(high - base)], names=["key", "row_id", "at", "low", "high"])
    return run


def _lists(batch, name: str, *fields: str):
    """The fields of a list column as flat arrays, after the row of each element."""
    column = batch.column(name)
    many = np.diff(column.offsets.to_numpy())
    inner = column.flatten()
    return np.repeat(np.arange(len(column)), many), *(inner.field(f).to_numpy(zero_copy_only=False) for f in fields)


def _second_pass(length: int, gram: int, block: int):
    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("body"))
            row, at, low, high = _lists(batch, "runs", "at", "low", "high")
            base = off[row]
            near, far = at - high, at - low
            first = near // block
            many = far // block - first + 1
            pick = np.repeat(np.arange(len(at)), many)
            j = first[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(many) - many, many)
            at_all = (at + base)[pick]
            short, long_ = np.maximum(near[pick], j * block), np.minimum(far[pick], j * block + block - 1)
            core = range_hashes(data, at_all - j * block, at_all - j * block - block + 1 + length)
            name = range_hashes(data, at + base, at + base + gram)[pick]
            core = mix(core ^ mix(name + j.astype(np.uint64)))
            full = range_hashes(data, at_all - long_, at_all - short + length)
            full = mix(full ^ mix(core + (short * 65536 + long_).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [_signed(core), _signed(full), batch.column("row_id").take(pa.array(row[pick])),
                 pa.array(at_all - long_ - base[pick]), pa.array(long_ - short + 1)],
                names=["core", "full", "row_id", "start", "many"])
    return run


def _third_pass(length: int):
    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("body"))
            row, start, many, mark, core = _lists(batch, "blocks", "start", "many", "mark", "core")
            pick = np.repeat(np.arange(len(row)), many)
            s = start[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(many) - many, many)
            at = s + off[row][pick]
            yield pa.RecordBatch.from_arrays(
                [_signed(range_hashes(data, at, at + length)), pa.array(core.astype(np.int64)[pick]),
                 batch.column("row_id").take(pa.array(row[pick])), pa.array(s.astype(np.int64)), pa.array(mark.astype(bool)[pick])],
                names=["window", "core", "row_id", "start", "mark"])
    return run


def _cut(batches):
    for batch in batches:
        out = [[], [], [], [], []]
        for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
            merged: list[list[int]] = []
            for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            kept, at = hashlib.sha256(), 0
            for a, b in merged:
                kept.update(body[at:a])
                at = b
            kept.update(body[at:])
            row = (len(body), sum(b - a for a, b in merged), len(merged), kept.hexdigest(),
                   [{"start": a, "end": b} for a, b in merged])
            for column, value in zip(out, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans."""
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("row_id", F.monotonically_increasing_id())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_texts_{uuid4().hex}"
    (rows.repartition(buckets, "row_id").write.bucketBy(buckets, "row_id").option("compression", "zstd")
     .format("parquet").saveAsTable(name))
    try:
        # The result is thin; with it written the texts are not needed any more.
        return written(_spans(spark.table(name), dict(rows.dtypes)["doc_id"], length, gram, block), "suffix_spans")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _repeated(rows: DataFrame, name: str, *keys: str) -> DataFrame:
    """The keys of more than one row, written: only a join of two plain shuffles is split where a key is
    hot, as that of a very common passage is."""
    return written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys), name)


def _spans(body: DataFrame, kind: str, length: int, gram: int, block: int) -> DataFrame:
    """The three passes over the bucketed texts (doc_id, body, row_id)."""
    runs = written(body.mapInArrow(_first_pass(length, gram), "key bigint, row_id bigint, at bigint, low bigint, high bigint"),
                   "suffix_runs")
    shared = _repeated(runs, "suffix_shared", "key")
    per_row = runs.join(shared, "key", "left_semi").groupBy("row_id").agg(
        F.collect_list(F.struct("at", "low", "high")).alias("runs"))
    blocks = written(body.join(per_row, "row_id").select("row_id", "body", "runs").mapInArrow(
        _second_pass(length, gram, block), "core bigint, full bigint, row_id bigint, start bigint, many bigint"), "suffix_blocks")

    extents = written(blocks.groupBy("full", "core").agg(
        F.count("*").alias("n"), F.min(F.struct("row_id", "start", "many")).alias("one")), "suffix_extents")
    whole = blocks.join(extents.where("n > 1").select("full", "core"), ["full", "core"], "left_semi").select(
        "row_id", "start", (F.col("start") + F.col("many") - 1 + length).alias("end"))
    split = _repeated(extents, "suffix_split", "core")
    open_ = extents.join(split, "core", "left_semi").select("one.*", (F.col("n") == 1).alias("mark"), "core")
    per_row = open_.groupBy("row_id").agg(F.collect_list(F.struct("start", "many", "mark", "core")).alias("blocks"))
    windows = written(body.join(per_row, "row_id").select("row_id", "body", "blocks").mapInArrow(
        _third_pass(length), "window bigint, core bigint, row_id bigint, start bigint, mark boolean"), "suffix_windows")
    twice = _repeated(windows, "suffix_twice", "window", "core")
    single = windows.where("mark").join(twice, ["window", "core"], "left_semi").select(
        "row_id", "start", (F.col("start") + length).alias("end"))

    per_row = whole.union(single).groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return body.join(per_row, "row_id", "left").select("doc_id", "body", "spans").mapInArrow(
        _cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
              "removed array<struct<start: bigint, end: bigint>>")
