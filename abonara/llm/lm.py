"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The filter is dealt over buckets of n-gram hashes and grows with the corpus: each bucket counts its
training n-grams exactly, quantises the counts to half octaves, and writes an n-gram of level q as q
entries, 1 to q, into a segment of ``BITS`` bits an entry. A lookup probes levels upwards until one is
missing, so false positives, about one in a hundred as the share of set bits does not change with the
input, can only raise a count. Every n-gram is stored, also those seen once.

A filter that grows cannot be sent whole to every worker, so probes travel to the segments instead:
texts are dealt into chunks of about ``CHUNK`` bytes, a chunk sends each of its distinct n-grams once,
with its training count, and gets back the level that the segment answers. Chunks are written once,
bucketed, and are not moved again. Probabilities interpolate the bigram with the unigram, both from
the answered levels. The base score needs exact token counts, which come back by the same way.

Tokens are identified by 64-bit hashes, bigrams by 32 bits inside their bucket; as buckets follow the
size of the input, about one bigram in a thousand shares its number with another at any size.

Nulls and empty texts are one end token. A null id counts as training. Repeated documents count and
score one by one. With no training text every count is 0. Empty tables give empty results;
other columns are not read. A very long text is a chunk of its own.
"""

from __future__ import annotations

from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import LOWER, chunks, flat, mix, row_starts, texts, word_hashes, word_spans, written
from abonara.llm.toxicity import held_out

PROBES = 3
#: Bits of a segment per entry: about a fifth of them are set.
BITS = 12
BIGRAM_SHARE = 0.35
FOLDS = 10
#: Bytes of text in a chunk, of a bucket of chunks, and per bucket of n-grams.
CHUNK, GROUP, BUCKET = 8 << 20, 32 << 20, 8 << 20
#: Beyond these numbers groups and buckets grow instead, so that a chunk still sends several n-grams to each
#: bucket: at 100 TB a bucket holds 1 GB.
MAX_GROUPS, MAX_BUCKETS = 50_000, 100_000
#: Level of a count of 2^62; a full filter would answer yes for ever.
TOP_LEVEL = 125
_END = np.uint64(0x5851F42D4C957F2D)
_BEGIN = np.uint64(0x14057B7EF767814F)
_LEFT = np.uint64(0x2545F4914F6CDD1D)


def tokens(data: np.ndarray, off: np.ndarray):
    """(hashes, row starts): the words of each row and one end token after them."""
    low = LOWER[data]
    start, end, rows, inside = word_spans(low, off)
    words = word_hashes(low, start, end, inside)
    n = len(off) - 1
    at = row_starts(rows, n)
    out = np.full(len(words) + n, _END, np.uint64)
    place = np.arange(len(words)) + rows
    out[place] = words
    return out, at + np.arange(n + 1)


def bigrams(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it (or the begin of the row)."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[at[:-1]] = _BEGIN
    return mix(before * _LEFT + hashes), before


class Filter(NamedTuple):
    """One segment of the Bloom filter."""

    bits: np.ndarray

    @property
    def full(self) -> float:
        return float(np.unpackbits(self.bits).mean())

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Highest level up to which every level is present."""
        level = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        step = 0
        while len(alive) and step < TOP_LEVEL:
            step += 1
            found = np.ones(len(alive), bool)
            for place in _places(keys[alive], step, len(self.bits) * 8):
                found &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            alive = alive[found]
            level[alive] = step
        return level


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _places(key: np.ndarray, level, bits: int):
    seed = mix(key + (np.asarray(level).astype(np.uint64) << np.uint64(32)) + np.uint64(1 << 60))
    first, step = seed & np.uint64(0xFFFFFFFF), (seed >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((first + np.uint64(k) * step) % np.uint64(bits)).astype(np.int64)


def quantised(count: np.ndarray) -> np.ndarray:
    """Level of a count: one more for every half octave; 0 for none."""
    return np.where(count > 0, 1 + np.floor(2 * np.log2(np.maximum(count, 1)) + 1e-9), 0).astype(np.int64)


def restored(level: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; small counts are exact to the level."""
    return np.where(level > 0, np.maximum(2.0 ** ((level - 1) / 2), (2.0 ** ((level - 1) / 2) + 2.0 ** (level / 2) - 1) / 2), 0.0)


def segment(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits of all entries of the keys; the size follows the number of entries."""
    level = quantised(counts)
    bits = np.zeros(max(8, -(-int(level.sum()) * BITS // 8)), np.uint8)
    for step in range(1, int(level.max(initial=0)) + 1):
        for place in _places(keys[level >= step], step, len(bits) * 8):
            np.bitwise_or.at(bits, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))
    return bits


def _short(keys: np.ndarray) -> np.ndarray:
    return keys.astype(np.uint64) & np.uint64(0xFFFFFFFF)


def _dealt(size: int):
    """Rows with the number of their chunk: a task's rows in order, cut at about ``size`` bytes."""
    def run(batches):
        task = TaskContext.get().partitionId()
        chunk, held = 0, 0
        for batch in batches:
            _, off = flat(batch.column("body"))
            numbers = np.zeros(len(batch), np.int64)
            for row, many in enumerate(np.diff(off)):
                if held and held + many > size:
                    chunk, held = chunk + 1, 0
                held += int(many)
                numbers[row] = (task << 32) + chunk
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=[*batch.schema.names, "chunk"])
    return run


class Grams(NamedTuple):
    """N-grams of a chunk: distinct ones in order of their buckets, and which of them each token has."""

    keys: np.ndarray
    cut: np.ndarray
    place: np.ndarray


def _distinct(hashes: np.ndarray, buckets: int) -> Grams:
    keys, place = np.unique(hashes, return_inverse=True)
    bucket = _bucket(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return Grams(keys[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), back[place])


def _chunk_tokens(body: pa.Array):
    """(hashes, row starts, pairs, tokens before) of the rows of a chunk."""
    data, off = flat(body)
    parts, starts = [], [np.zeros(1, np.int64)]
    for first, last in chunks(off):
        hashes, at = tokens(data[off[first]:off[last]], off[first:last + 1] - off[first])
        pairs, before = bigrams(hashes, at)
        parts.append((hashes, pairs, before))
        starts.append(at[1:] + starts[-1][-1])
    hashes, pairs, before = map(np.concatenate, zip(*parts))
    return hashes, np.concatenate(starts), pairs, before


_SENT = "size int, bucket int, chunk long, keys binary, counts binary"


def _send(buckets: int):
    """Distinct n-grams of a chunk with their counts in its training texts, by bucket."""
    def run(table: pa.Table) -> pa.Table:
        hashes, at, pairs, _ = _chunk_tokens(table.column("body").combine_chunks())
        train = np.repeat(~np.array(table.column("held_out").to_pylist(), bool), np.diff(at))
        out = {n: [] for n in ("size", "bucket", "chunk", "keys", "counts")}
        for size, grams in ((1, _distinct(hashes, buckets)), (2, _distinct(pairs, buckets))):
            counts = np.bincount(grams.place[train], minlength=len(grams.keys)).astype(np.uint32)
            keys = grams.keys if size == 1 else grams.keys.astype(np.uint32)
            for b in np.flatnonzero(np.diff(grams.cut)):
                pick = slice(grams.cut[b], grams.cut[b + 1])
                out["size"].append(size)
                out["bucket"].append(int(b))
                out["chunk"].append(table.column("chunk")[0].as_py())
                out["keys"].append(keys[pick].tobytes())
                out["counts"].append(counts[pick].tobytes())
        return pa.table(out, schema=pa.schema([("size", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()),
                                               ("keys", pa.binary()), ("counts", pa.binary())]))
    return run


_ANSWER = pa.schema([("chunk", pa.int64()), ("size", pa.int32()), ("bucket", pa.int32()), ("levels", pa.binary()), ("exact", pa.binary()),
                     ("tokens", pa.int64()), ("kinds", pa.int64()), ("bits", pa.int64()), ("ones", pa.int64())])


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: its segment of the filter, and for each chunk the levels of what it sent.

    ``exact`` has the counts themselves, of single tokens only. The bucket's own sums stand on its first row.
    """
    size = table.column("size")[0].as_py()
    sent = [np.frombuffer(x, np.uint64 if size == 1 else np.uint32) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
    keys, place = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.bincount(place, counts, minlength=len(keys)).astype(np.int64)
    seen = total > 0
    part = Filter(segment(_short(keys[seen]), total[seen]))
    levels = part.level(_short(keys)).astype(np.uint8)[place]
    exact, ends = total[place], np.cumsum([0] + [len(x) for x in sent])
    first = np.arange(len(sent)) == 0
    sums = {"tokens": total.sum() if size == 1 else 0, "kinds": seen.sum() if size == 1 else 0,
            "bits": 8 * len(part.bits), "ones": int(np.unpackbits(part.bits).sum())}
    cuts = list(zip(ends[:-1], ends[1:]))
    return pa.table({
        "chunk": table.column("chunk"), "size": table.column("size"), "bucket": table.column("bucket"),
        "levels": pa.array([levels[a:b].tobytes() for a, b in cuts], pa.binary()),
        "exact": pa.array([exact[a:b].tobytes() if size == 1 else b"" for a, b in cuts], pa.binary()),
        **{n: pa.array(np.where(first, v, 0), pa.int64()) for n, v in sums.items()}}, schema=_ANSWER)


class Model(NamedTuple):
    """Size of the training text: tokens and distinct tokens."""

    total: int
    kinds: int


def _log_base(count, total: int, kinds: int):
    return np.log10((count + 0.1) / (total + 0.1 * (kinds + 1)))


def log_probabilities(single: np.ndarray, begin: np.ndarray, context: np.ndarray, both: np.ndarray, at: np.ndarray,
                      model: Model) -> np.ndarray:
    """log10 of the smoothed probability of each token after the one before it.

    ``single``, ``context`` and ``both`` are the restored counts of the token, of the one before and
    of the two together; a row's first token follows the row's begin, as often as there are rows.
    """
    unigram = (single + 0.1) / (model.total + 0.1 * (model.kinds + 1))
    context = context.copy()
    context[at[:-1]] = np.inf  # the begin is no token; the filter knows its pairs only
    both = np.minimum(both, np.minimum(context, single))
    context[at[:-1]] = np.maximum(1.0, begin)
    share = np.where(context > 0, BIGRAM_SHARE, 0.0)
    return np.log10(share * np.minimum(1.0, both / np.maximum(context, 1)) + (1 - share) * unigram)


def _score(buckets: int, model: Model):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, at, pairs, _ = _chunk_tokens(docs.column("body").combine_chunks())
        one, two = _distinct(hashes, buckets), _distinct(pairs, buckets)
        levels, exact = {1: np.zeros(len(one.keys), np.uint8), 2: np.zeros(len(two.keys), np.uint8)}, np.zeros(len(one.keys), np.int64)
        for size, bucket, found, counts in zip(*(answers.column(c).to_pylist() for c in ("size", "bucket", "levels", "exact"))):
            cut = (one if size == 1 else two).cut
            levels[size][cut[bucket]:cut[bucket + 1]] = np.frombuffer(found, np.uint8)
            if size == 1:
                exact[cut[bucket]:cut[bucket + 1]] = np.frombuffer(counts, np.int64)
        single = restored(levels[1].astype(np.int64))[one.place]
        both = restored(levels[2].astype(np.int64))[two.place]
        context = np.empty_like(single)
        context[1:] = single[:-1]
        context[at[:-1]] = 0.0
        # Every row ends with the end token, so its count is that of the rows.
        score = log_probabilities(single, single[at[1:] - 1], context, both, at, model)
        count = exact[one.place]
        sums = lambda x: np.add.reduceat(x, at[:-1])
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(np.diff(at), pa.int64()),
            "n_known": pa.array(sums((count > 0).astype(np.int64)), pa.int64()),
            "base_score": pa.array(sums(_log_base(count, model.total, model.kinds)), pa.float64()), "score": pa.array(sums(score), pa.float64())})
    return run


def scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, filter_fill.

    ``filter_fill`` is the share of set bits over all segments.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("held_out", held_out(folds=FOLDS))
    kind = dict(rows.dtypes)["doc_id"]
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets, groups = min(max(16, size // BUCKET), MAX_BUCKETS), min(max(4, size // GROUP), MAX_GROUPS)
    name = f"lm_texts_{uuid4().hex}"
    (rows.mapInArrow(_dealt(CHUNK), f"doc_id {kind}, body binary, held_out boolean, chunk long").write
     .bucketBy(groups, "chunk").option("compression", "zstd").format("parquet").saveAsTable(name))
    try:
        dealt = spark.table(name)
        sent = dealt.groupBy("chunk").applyInArrow(_send(buckets), _SENT)
        answers = written(sent.groupBy("size", "bucket").applyInArrow(
            _answer, "chunk long, size int, bucket int, levels binary, exact binary, tokens long, kinds long, bits long, ones long"), "lm_answers")
        sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kinds", "bits", "ones")]).first()
        model = Model(sums["tokens"], sums["kinds"])
        scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _score(buckets, model), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        # The scores are thin; with them written the texts are not needed any more.
        out = written(scored, "lm_scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(model.total)).cast("long").alias("train_tokens"),
                      "base_score", "score", F.lit(sums["ones"] / max(1, sums["bits"])).alias("filter_fill"))
