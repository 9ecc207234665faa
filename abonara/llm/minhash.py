"""Near-duplicates by min-max hashing.

Every permutation gives two signature values, the smallest and the largest image of the document's
shingle set, so half the hash evaluations fill a signature. Both agree with chance J (the Jaccard
similarity), and bands take values of one kind from different permutations, so the values inside a
band are independent: with 32 bands of 4 a pair at J = 0.75 shares no band with chance 5e-6.

Documents with equal sets become one class first. In every bucket each class is compared with one
leader (a star, never all pairs), links are confirmed on the full sets, and linked classes form
components. Then the rest is done exactly: in buckets that still hold several components, the
members outside of the largest one are compared with the members of other components. Every pair
that shares a bucket is thus either compared or already connected; nothing is capped or dropped.

Pairs are built only if a sketch allows a link: the parities of how many shingles of a set fall in
each of 512 cells differ in at most as many cells as the sets have shingles not in common, and that
is at most a seventh of both sizes at J = 0.75. The bound is exact, so it loses no link.

Sets hold 64-bit hashes of shingles. A document with no words has the empty set and is linked with
nothing; one with fewer words than a shingle has its whole sequence as one shingle. A document
without id cannot be named as a partner: it is its own component, null, and is kept. Repeated rows
are exact copies and share a component (each is kept if it carries the smallest id). An empty table
gives an empty result; other columns are not read. A very long text is hashed in its own chunk, with
memory in proportion to that text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import (LOWER, chunks, flat, mix, row_starts, texts, window_hashes, word_hashes,
                                word_spans, written)

WORDS = 5
BANDS, BAND_ROWS = 32, 4
SIMILAR, OF = 75, 100
#: 64-bit words of the parity sketch.
SKETCH = 8

_rng = np.random.Generator(np.random.PCG64(71))
_PERMUTATIONS = BANDS * BAND_ROWS // 2
_A = (_rng.integers(1, 2**63, _PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_B = _rng.integers(0, 2**63, _PERMUTATIONS, dtype=np.uint64)[:, None]
_FOLD = _rng.integers(1, 2**63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS):
    """The sorted distinct shingle hashes of each row."""
    for first, last in chunks(off):
        cut = off[first:last + 1] - off[first]
        low = LOWER[data[off[first]:off[last]]]
        start, end, rows, inside = word_spans(low, cut)
        hashes = word_hashes(low, start, end, inside)
        shingles = window_hashes(hashes, words)
        at = row_starts(rows, last - first)
        for k in range(last - first):
            a, b = at[k], at[k + 1]
            if b - a >= words:
                yield np.unique(shingles[a:b - words + 1])
            elif b > a:
                yield mix(window_hashes(hashes[a:b], int(b - a)) + _SHORT * np.arange(b - a, b - a + 1, dtype=np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def min_max(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest image of the set under every permutation."""
    low = np.full(_PERMUTATIONS, 2**64 - 1, np.uint64)
    high = np.zeros(_PERMUTATIONS, np.uint64)
    for k in range(0, len(shingles), 4096):
        images = shingles[None, k:k + 4096] * _A
        images += _B
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    return low, high


def band_keys(shingles: np.ndarray) -> np.ndarray:
    low, high = min_max(shingles)
    values = np.concatenate([low, high]).reshape(BANDS, BAND_ROWS)
    return mix((values * _FOLD).sum(axis=1, dtype=np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """512 bits: the parity of the number of shingles in each cell."""
    cells = np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def may_link(n_a, n_b, sketch_a, sketch_b):
    """False only for pairs that cannot reach the threshold, by their sizes or by their sketches."""
    apart = sum((F.bit_count(sketch_a[k].bitwiseXOR(sketch_b[k])) for k in range(1, SKETCH)),
                F.bit_count(sketch_a[0].bitwiseXOR(sketch_b[0])))
    sizes = OF * F.least(n_a, n_b) >= SIMILAR * F.greatest(n_a, n_b)
    # |A or B| - |A and B| <= (1 - t) / (1 + t) * (|A| + |B|) with t = SIMILAR / OF
    return sizes & ((OF + SIMILAR) * apart <= (OF - SIMILAR) * (n_a + n_b))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _features(batches):
    for batch in batches:
        data, off = flat(batch.column("body"))
        size, name, bands, sketch = [], [], [], []
        for s in shingle_sets(data, off):
            size.append(len(s))
            name.append(digest(s))
            bands.append(band_keys(s) if len(s) else np.zeros(0, np.int64))
            sketch.append(parities(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(name, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "digest", "bands", "sketch"])


def features(docs: DataFrame) -> DataFrame:
    """Per document: set size, digest of the set, band keys, parity sketch."""
    return docs.mapInArrow(_features, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles bigint, digest binary, "
                                      "bands array<bigint>, sketch array<bigint>")


def _confirm(batches):
    """Keep the pairs whose full sets are similar; a text that is not the one of its class is passed over."""
    leader, cached = None, None
    for batch in batches:
        rows = {c: batch.column(c).to_pylist() for c in ("a", "b", "digest_a", "digest_b")}
        ours = shingle_sets(*flat(batch.column("body_a")))
        theirs = batch.column("body_b")
        a, b = [], []
        for k, one in enumerate(ours):
            if (rows["b"][k], rows["digest_b"][k]) != leader:
                other = next(shingle_sets(*flat(theirs.slice(k, 1))))
                if digest(other) != rows["digest_b"][k]:
                    continue
                leader, cached = (rows["b"][k], rows["digest_b"][k]), other
            if digest(one) != rows["digest_a"][k]:
                continue
            shared = len(np.intersect1d(one, cached, assume_unique=True))
            if OF * shared >= SIMILAR * (len(one) + len(cached) - shared):
                a.append(rows["a"][k])
                b.append(rows["b"][k])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes with at least the threshold similarity; sets are made anew from the texts."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    wanted = wanted.join(classes.select("node", "rep", "digest"), "node")
    body = docs.join(wanted, docs["doc_id"] == wanted["rep"]).select("node", "digest", "body")
    side = lambda s: body.select(*[F.col(c).alias(f"{c}_{s}") for c in body.columns])
    one = pairs.join(side("a"), F.col("a") == F.col("node_a")).drop("node_a")
    both = one.join(side("b"), F.col("b") == F.col("node_b")).drop("node_b")
    return both.mapInArrow(_confirm, "a bigint, b bigint").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    Each round hooks a node to its smallest smaller neighbour, shortens the paths, and contracts
    the edges; rounds go on until no edge is left between two components.
    """
    current = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .where("a < b").distinct(), f"{name}_edges")
    labels = current.select(F.col("a").alias("node")).union(current.select("b")).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not current.isEmpty():
        hook = current.groupBy("b").agg(F.min("a").alias("to")).select(F.col("b").alias("from"), "to")
        for _ in range(3):
            nxt = hook.select(F.col("from").alias("mid"), F.col("to").alias("far"))
            hook = hook.join(nxt, F.col("to") == F.col("mid"), "left").select("from", F.coalesce("far", "to").alias("to"))
        hook = written(hook, f"{name}_hook")
        moved = lambda df, c, hook=hook: (df.join(hook, F.col(c) == F.col("from"), "left")
                                          .withColumn(c, F.coalesce("to", c)).drop("from", "to"))
        labels = moved(labels, "component")
        current = moved(moved(current, "a"), "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        current = written(current.where("a < b").distinct(), f"{name}_edges")
    return written(labels, f"{name}_labels")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable), kept (it is that id)."""
    rows = texts(docs, id_col, text_col)
    named = rows.where("doc_id is not null")
    each = written(features(rows), "minhash_features")
    full = each.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"),
                                         F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "minhash_classes")
    sketches = lambda s: classes.select(F.col("node").alias(f"node_{s}"), F.col("n").alias(f"n_{s}"),
                                        F.col("sketch").alias(f"sketch_{s}"))
    alike = may_link(F.col("n_a"), F.col("n_b"), F.col("sketch_a"), F.col("sketch_b"))

    members = classes.select(F.explode("bands").alias("key"), "node")
    buckets = members.groupBy("key").agg(F.count("*").alias("many"), F.min("node").alias("lead"))
    buckets = buckets.where("many > 1").select(F.col("key").alias("bucket"), "lead")
    shared = written(members.join(buckets, F.col("key") == F.col("bucket")).select("key", "node", "lead"), "minhash_buckets")
    stars = shared.where("node != lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    stars = stars.join(sketches("a"), F.col("a") == F.col("node_a")).join(sketches("b"), (F.col("b") == F.col("node_b")) & alike)
    stars = written(stars.select("a", "b"), "minhash_stars")
    links = written(confirmed(stars, classes, named), "minhash_links")
    label = components(links, "minhash_first")

    # What stars leave open: buckets with members of several components.
    placed = shared.select("key", "node").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("many"))
    mixed = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("many", "component")).alias("largest"))
    mixed = mixed.where("parts > 1").select(F.col("key").alias("bucket"), "largest")
    open_ = placed.join(mixed, F.col("key") == F.col("bucket")).select("key", "node", "component", "largest")
    open_ = written(open_.join(classes.select("node", "n", "sketch", "bands"), "node"), "minhash_open")
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "component", "sketch", "bands")]
    # A pair that shares several buckets is built in the first of them only.
    first_shared = F.array_intersect("bands_a", "bands_b")[0] == F.col("key")
    small = open_.where("component != largest").select("key", *side("a"))
    other = open_.select(F.col("key").alias("bucket"), "largest", *side("b"))
    rest = small.join(other, (F.col("key") == F.col("bucket")) & (F.col("component_a") != F.col("component_b")) & alike & (
        (F.col("component_b") == F.col("largest")) | (F.col("node_a") < F.col("node_b"))) & first_shared)
    rest = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    done = stars.union(stars.select("b", "a"))
    rest = written(rest.join(done, ["a", "b"], "left_anti"), "minhash_rest")
    if not rest.isEmpty():
        label = components(links.union(confirmed(rest, classes, named)), "minhash_second")

    per_class = classes.select("digest", "node", "rep").join(label, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = per_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    per_class = per_class.join(lowest, "component").select(F.col("digest").alias("class"), "component_id")
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("digest"))
    out = each.select("doc_id", "n_shingles", key.alias("own")).join(per_class, F.col("own") == F.col("class"), "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
