"""Quality rules: a hashed word and character n-gram logistic regression beside fixed rules.

The classifier is fitted on at most ``max_train`` labelled rows (the rows with the smallest hash
of their id, so the choice is stable), in batches on the driver: the model is a fixed table of
``2 ** bits`` weights. Every fourth training row is held out of the fit; on those a two-parameter
logistic curve turns scores into probabilities. Scoring runs in Arrow batches over whole texts.
A document is rejected by the model when its probability of being low quality is at least
``reject_at``.

Nulls and empty texts have no words (they fail the word rule); labels other than 0 and 1, without
a document or repeated with different values are dropped from training; repeated documents are
scored one by one; with fewer than ``MIN_CLASS`` rows of either class there is no verdict and the
fixed rules decide alone; an empty table gives an empty result; other columns are not read. A very long
text is scored in a chunk of its own, with memory in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import (LOWER, SPACE, chunks, flat, mix, row_starts, texts, window_hashes,
                                word_hashes, word_spans)

MAX_TRAIN = 2000
MIN_CLASS = 5
BITS = 16
REPEAT_WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
CHAR_N = 4
#: Characters enter the model by their kind for this second view: runs of capitals, marks, digits.
KIND = np.full(256, 4, np.uint64)
for _low, _high, _kind in ((97, 123, 0), (65, 91, 1), (48, 58, 2), (128, 256, 0)):
    KIND[_low:_high] = _kind
KIND[SPACE] = 3
for _place, _mark in enumerate(b"!?.,;:#*$%&|<>-_=/"):
    KIND[_mark] = 5 + _place


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def _features(data, off, words, rows, bits: int):
    """Hashed features of each row as (row, slot) pairs, one slot type after the other."""
    size = np.uint64(64 - bits)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    yield rows, (words >> size).astype(np.int64)
    if len(words) > 1:
        pair = window_hashes(words, 2)
        same = rows[1:] == rows[:-1]
        yield rows[1:][same], (pair[same] >> size).astype(np.int64)
    last = len(data) - CHAR_N + 1
    if last > 0:
        inside = owner[CHAR_N - 1:] == owner[:last]
        for salt, symbols in ((1, LOWER[data].astype(np.uint64)), (2, KIND[data])):
            code = np.zeros(last, np.uint64)
            for k in range(CHAR_N):
                code = code * np.uint64(257) + symbols[k:k + last]
            code = mix(code + np.uint64(salt << 56))
            yield owner[:last][inside], (code[inside] >> size).astype(np.int64)


def _scores(data, off, words, rows, model: Model, bits: int) -> np.ndarray:
    """Mean weight of each kind of feature, summed over the kinds."""
    n = len(off) - 1
    total = np.full(n, model.bias)
    for row, slot in _features(data, off, words, rows, bits):
        many = np.maximum(np.bincount(row, minlength=n), 1)
        total += np.bincount(row, model.weights[slot], minlength=n) / many
    return total


def _lowered_words(data, off):
    low = LOWER[data]
    start, end, rows, inside = word_spans(low, off)
    return word_hashes(low, start, end, inside), rows


def fit(rows: list[tuple[bytes, int]], bits: int = BITS, rounds: int = 40, rate: float = 4.0) -> Model | None:
    """Mean-feature logistic regression by full-batch steps with momentum; then the curve."""
    label = np.array([y for _, y in rows], float)
    held = np.arange(len(rows)) % 4 == 3
    if min((label[~held] == 1).sum(), (label[~held] == 0).sum()) < MIN_CLASS or len(set(label[held])) < 2:
        return None
    row_all, slot_all, value_all = [], [], []
    for k, (body, _) in enumerate(rows):
        data = np.frombuffer(body or b" ", np.uint8)
        off = np.array([0, len(data)])
        words, owner = _lowered_words(data, off)
        for row, slot in _features(data, off, words, owner, bits):
            slots, many = np.unique(slot, return_counts=True)
            row_all.append(np.full(len(slots), k, np.int32))
            slot_all.append(slots.astype(np.int32))
            value_all.append((many / max(1, len(slot))).astype(np.float32))
    row, slot, value = map(np.concatenate, (row_all, slot_all, value_all))
    use = ~held[row]
    weight = np.where(label == 1, 0.5 / (label[~held] == 1).sum(), 0.5 / (label[~held] == 0).sum())
    w, step, bias = np.zeros(1 << bits), np.zeros(1 << bits), 0.0
    r, s, v = row[use], slot[use], value[use]
    scale = 1.0 / np.sqrt(np.bincount(s, v.astype(float) ** 2, minlength=1 << bits) / max(1, (~held).sum()) + 1e-6)
    for _ in range(rounds):
        z = np.bincount(r, w[s] * v, minlength=len(rows)) + bias
        gap = np.where(held, 0.0, (label - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) * weight)
        step = 0.8 * step + rate * scale * np.bincount(s, gap[r] * v, minlength=1 << bits)
        w += step
        bias += gap.sum()
    z = np.bincount(row, w[slot] * value, minlength=len(rows)) + bias
    x, y = z[held], label[held]
    # Two-parameter curve on the held-out rows by ridge-damped Newton steps, with softened labels.
    up, down = (y == 1).sum(), (y == 0).sum()
    y = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    design = np.stack([x, np.ones_like(x)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (y - p) - 1e-3 * theta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return Model(w.astype(np.float32), bias, float(theta[0]), float(theta[1]))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_train: int) -> list[tuple[bytes, int]]:
    """At most ``max_train`` labelled texts, by the hash of the id; a bounded list."""
    known = (labels.select(labels["doc_id"].alias("k"), labels[label_col].cast("int").alias("y"))
             .where("k is not null and y in (0, 1)").groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("z"))
             .where("y = z"))
    chosen = known.orderBy(F.xxhash64("k"), "k").limit(max_train)
    found = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("k")).groupBy("doc_id").agg(
        F.min("body").alias("body"), F.first("y").alias("y"))
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id").select("body", "y").limit(max_train).toLocalIterator()
    return [(bytes(r.body), r.y) for r in rows]


def base_counts(data, off):
    """word_chars, n_words, n_symbols, n_repeat_words and n_dup_lines of each row."""
    n = len(off) - 1
    start, end, rows, inside = word_spans(data, off)
    sums = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[off])
    chars = sums(inside & ((data & 0xC0) != 0x80))
    symbols = sums(SYMBOLS[data])
    words = word_hashes(data, start, end, inside)
    many = np.bincount(rows, minlength=n)
    repeat = np.zeros(n, np.int64)
    windows = window_hashes(words, REPEAT_WINDOW)
    if len(windows):
        own = rows[:len(windows)]
        key = windows ^ mix(own.astype(np.uint64) + np.uint64(1))
        whole = own == rows[REPEAT_WINDOW - 1:]
        place = np.flatnonzero(whole)
        order = np.argsort(key[place], kind="stable")
        k = key[place][order]
        equal = k[1:] == k[:-1]
        twice = np.zeros(len(k), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        hit = place[order][twice]
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + REPEAT_WINDOW, -1)
        repeat = np.bincount(rows, np.cumsum(cover[:-1]) > 0, minlength=n).astype(np.int64)
    dup = np.zeros(n, np.int64)
    raw = data.tobytes()
    for k in range(n):
        lines = [x for x in raw[off[k]:off[k + 1]].split(b"\n") if x.strip()]
        dup[k] = len(lines) - len(set(lines))
    return many, chars, symbols, dup, repeat


_OUT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "p_low double")


def _scorer(handle, bits: int):
    def run(batches: Iterator[pa.RecordBatch]):
        model = handle.value
        for batch in batches:
            data, off = flat(batch.column("body"))
            parts = []
            for first, last in chunks(off):
                cut = off[first:last + 1] - off[first]
                part = data[off[first]:off[last]]
                counts = base_counts(part, cut)
                if model is None:
                    p = np.full(last - first, np.nan)
                else:
                    words, rows = _lowered_words(part, cut)
                    z = _scores(part, cut, words, rows, model, bits)
                    p = 1 / (1 + np.exp(np.clip(model.slope * z + model.shift, -30, 30)))
                parts.append([*counts, p])
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0)] * 6
            arrays = [pa.array(x, pa.int64()) for x in columns[:5]] + [pa.array(columns[5], pa.float64())]
            names = [x.split()[0] for x in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])
    return run


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", max_train: int = MAX_TRAIN, bits: int = BITS, reject_at: float = 0.5,
            min_words: int = 20, repeat_share: tuple[int, int] = (30, 100), row_col: str | None = None) -> DataFrame:
    """Per document: the counts, ``base_failed``, ``p_low`` (null without a model) and ``kept``.

    ``row_col``: a column to name the rows by in the result (as doc_id) where ids repeat or are null.
    """
    model = fit(training_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")),
                              labels, label_col, max_train), bits)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    rows = texts(docs, row_col or id_col, text_col)
    scored = rows.mapInArrow(_scorer(handle, bits), f"doc_id {dict(rows.dtypes)['doc_id']}, {_OUT}")
    above, below = repeat_share
    failed = (F.col("n_words") < min_words) | (below * F.col("n_repeat_words") > above * F.col("n_words"))
    low = F.when(~F.isnan("p_low"), F.col("p_low"))
    return scored.withColumn("p_low", low).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(F.col("p_low") >= reject_at, F.lit(False)))
