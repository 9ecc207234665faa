"""Sharding by sampled splitters: range partitions of near-equal bytes, exact to one document.

Records are ordered by (hash of the text, hash of the id, salt), so equal texts stay next to each
other. A bounded, size-weighted sample of keys gives quantile boundaries that cut the order into
many ranges; a range that still holds too much is cut again with a sample of its own, also inside
one hot text, as the id is part of the key. Running sums then need only the sizes of the ranges
(bounded by their number) and a window inside each range, so the cut into shards is exact: every
shard starts at its share of all bytes, to within one document.

Law ``bytes``. Nulls: a null text has no bytes, a null id sorts first. Rows equal in id and text
are dealt by a salt, so that no range is indivisible. Ties in the order are rows that cannot be
told apart. An empty table gives an empty result; other columns are not read. Equal texts stay together except
where a shard ends inside a group of them. A very long text is one row of its size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from abonara.llm.common import crc, utf8_size, written

ROW_BYTES = 16
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 24
#: A range above this multiple of the mean is cut again.
OVERFULL = 2.5
ROUNDS = 4
_KEY = 48  # 16 hexadecimal digits each, in the order of the signed values


def _key():
    digits = lambda name: F.lpad(F.hex(F.col(name).bitwiseXOR(F.lit(-2 ** 63))), 16, "0")
    return F.concat(digits("text_hash"), digits("id_hash"), digits("salt"))


def range_of(splitters: np.ndarray):
    """Column function: the range in which a key of ``_KEY`` characters lies."""
    @F.pandas_udf("int")
    def find(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy().astype(f"S{_KEY}"), side="right").astype(np.int32))
    return find


def _sample(rows: DataFrame, many: int) -> list:
    """``many`` keys drawn without replacement with chance in proportion to size: smallest -ln(u) / size."""
    u = (F.pmod(F.xxhash64("key", F.lit(7)), F.lit(2 ** 52)) + 0.5) / float(2 ** 52)
    return rows.orderBy(-F.log(u) / F.col("size"), "key").limit(many).select("key").collect()


def splitters(rows: DataFrame, ranges: int) -> np.ndarray:
    """Boundaries of about ``ranges`` ranges, each below ``OVERFULL`` times the mean where keys differ.

    The driver sees samples and the sizes of ranges, both bounded by ``ranges``.
    """
    picked = sorted(r.key.encode() for r in _sample(rows, ranges * SAMPLES_PER_RANGE))
    cuts = np.unique(np.array(picked[SAMPLES_PER_RANGE::SAMPLES_PER_RANGE], f"S{_KEY}"))
    for _ in range(ROUNDS):
        placed = rows.withColumn("range", range_of(cuts)("key"))
        held = {r["range"]: r["bytes"] for r in placed.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
        limit = OVERFULL * sum(held.values()) / ranges
        over = {k: v for k, v in held.items() if v > limit}
        if not over:
            break
        more = sorted(r.key.encode() for r in _sample(
            placed.where(F.col("range").isin(list(over))), SAMPLES_PER_RANGE * 2 * int(sum(over.values()) / limit + len(over))))
        grown = np.unique(np.concatenate([cuts, np.array(more[SAMPLES_PER_RANGE // 2::SAMPLES_PER_RANGE // 2], f"S{_KEY}")]))
        if len(grown) == len(cuts):
            break
        cuts = grown
    return cuts


def shards(docs: DataFrame, n: int = 40, *, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    ``keep``: further columns of ``docs`` to carry (their names stay).
    """
    text = docs[text_col].cast("string")
    rows = written(docs.select(
        docs[id_col].alias("doc_id"), (utf8_size(text) + ROW_BYTES).alias("size"),
        F.coalesce(crc(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.xxhash64(docs[id_col]).alias("id_hash"),
        F.monotonically_increasing_id().alias("salt"), *[docs[c] for c in keep]).withColumn("key", _key()), "shard_rows")
    cuts = splitters(rows.select("key", "size"), n * RANGES_PER_SHARD)
    placed = rows.withColumn("range", range_of(cuts)("key"))
    held = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("docs"))
    # One row per range; their number is bounded by the number of shards.
    before = W.partitionBy(F.lit(0)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    total = W.partitionBy(F.lit(0))
    held = held.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                       F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
                       F.sum("bytes").over(total).alias("all_bytes"))
    inside = W.partitionBy("range").orderBy("key")
    upto = inside.rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.select("*", (F.row_number().over(inside) - 1).alias("place"),
                           F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("lead"))
    cut = ranked.join(held, "range").withColumn(
        "shard", F.least(F.lit(n - 1), F.floor(
            (F.col("bytes_before") + F.col("lead") + F.col("size") / 2) * n / F.col("all_bytes"))).cast("int"))
    cut = cut.withColumn("place", F.col("docs_before") + F.col("place"))
    first = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *keep)
