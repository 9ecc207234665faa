"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (A-Z lower-cased, ASCII marks cut off) and beginnings of words of ``PREFIX``
characters, as several languages build on stems. Which terms enter the vectors is learned from all
training labels: those whose share of label 1 lies ``Z_LEAST`` or more standard deviations away
from the base rate and is at least ``LIFT`` times it or at most the same part of it, at most
``MAX_TERMS``, the strongest first; other terms carry no evidence and only noise. The index holds
at most ``max_examples`` labelled vectors (the documents with the smallest hash of their id); equal
vectors are one entry with counts of both labels. A text's
neighbours are its ``k`` nearest entries by cosine; postings are cut into blocks with their highest
weight, and blocks whose bound is below the k-th similarity are left out of the sums, which leaves the
result exact. Votes weighted by similarity, with a prior at the base rate, make the score; the vote becomes a
probability by a logistic curve fitted on every fourth training row.

Labels of rows with crc32(id) mod 5 = 0 are never read. Broadcast size is bounded by the two
limits. Nulls, empty texts and texts without any term have no neighbours and score the prior of
such training texts. Labels other than 0 and 1 or contradicting each other are dropped. Without
both labels in training every score is the base rate (0 without labels). Repeated documents are
scored one by one; empty tables give empty results; other columns are not read. A very long text is one
vector, whatever its length.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import texts, written

PREFIX = (5, 7)
Z_LEAST = 6.0
LIFT = 3.0
MAX_TERMS = 4096
MAX_EXAMPLES = 20_000
FOLDS = 5
NEIGHBOURS = 25
BLOCK = 64
PRIOR_WEIGHT = 0.5
_MARKS = b"".join(bytes([b]) for b in range(33, 127) if not chr(b).isalnum())


def word_terms(word: bytes) -> tuple[bytes, ...]:
    """The word without marks around it, and its beginnings, each marked by a star."""
    word = word.strip(_MARKS)
    if not word:
        return ()
    text = word.decode("utf-8", "replace")
    return word, *(text[:size].encode() + b"*" for size in PREFIX if len(text) > size)


class Memory(dict):
    """Remembers what a function of a word gives; emptied when it is full."""

    def __init__(self, of, most: int = 200_000):
        self.of, self.most = of, most

    def __missing__(self, word: bytes):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.of(word)
        return value


def _label_counts(batches):
    """Documents with each term, by label, for one partition."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    of_word = Memory(word_terms)

    def rows():
        names = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_pydict({
            "term": pa.array(names, pa.binary()), "n0": pa.array([seen[0][x] for x in names], pa.int64()),
            "n1": pa.array([seen[1][x] for x in names], pa.int64())})

    for batch in batches:
        for body, label in zip(batch.column("body").to_pylist(), batch.column("label").to_pylist()):
            seen[label].update({term for word in set(body.lower().split()) for term in of_word[word]})
            if len(seen[0]) + len(seen[1]) > 300_000:
                yield rows()
                seen[0].clear()
                seen[1].clear()
    yield rows()


def selected_terms(train: DataFrame, total: tuple[int, int], z_least: float, max_terms: int) -> dict[bytes, float]:
    """Term -> inverse document frequency weight, over all training rows."""
    n0, n1 = total
    rate = n1 / (n0 + n1)
    counts = train.select("body", "label").mapInArrow(_label_counts, "term binary, n0 bigint, n1 bigint")
    counts = counts.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    many = F.col("n0") + F.col("n1")
    z = (F.col("n1") - many * rate) / F.sqrt(many * rate * (1 - rate))
    strong = counts.where(many >= 5).withColumn("z", z).where(F.abs("z") >= z_least)
    share = F.col("n1") / many
    strong = strong.where((share >= min(LIFT * rate, (1 + rate) / 2)) | (share * LIFT <= rate))
    rows = strong.orderBy(F.abs("z").desc(), "term").limit(max_terms).collect()
    return {bytes(r.term): math.log((1 + n0 + n1) / (1 + r.n0 + r.n1)) + 1 for r in rows}


class Index:
    """Entries (distinct vectors with label counts) behind blocked postings."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights = weights
        self.entry: dict[tuple, int] = {}
        self.labels: list[list[int]] = []
        self.empty = [0, 0]
        self.known = Memory(lambda word: tuple(t for t in word_terms(word) if t in weights))

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k != "known"}

    def __setstate__(self, state):
        vars(self).update(state)
        weights = self.weights
        self.known = Memory(lambda word: tuple(t for t in word_terms(word) if t in weights))

    def vector(self, body: bytes) -> tuple:
        found: dict[bytes, int] = {}
        known = self.known
        for word in body.lower().split():
            for term in known[word]:
                found[term] = found.get(term, 0) + 1
        raw = [(t, (1 + math.log(n)) * self.weights[t]) for t, n in sorted(found.items())]
        size = math.sqrt(sum(w * w for _, w in raw))
        return tuple((t, w / size) for t, w in raw)

    def add(self, vector: tuple, label: int) -> None:
        if not vector:
            self.empty[label] += 1
            return
        if vector not in self.entry:
            self.entry[vector] = len(self.labels)
            self.labels.append([0, 0])
        self.labels[self.entry[vector]][label] += 1

    def build(self) -> "Index":
        postings = defaultdict(list)
        for vector, k in self.entry.items():
            for term, w in vector:
                postings[term].append((k, w))
        self.blocks = -(-len(self.labels) // BLOCK)
        self.postings, self.highest = {}, {}
        for term, rows in postings.items():
            ids, w = np.array([k for k, _ in rows]), np.array([w for _, w in rows])
            self.postings[term] = (ids, w, ids // BLOCK)
            top = np.zeros(self.blocks)
            np.maximum.at(top, ids // BLOCK, w)
            self.highest[term] = top
        self.label_counts = np.array(self.labels, float).reshape(-1, 2)
        self.entry = {}
        return self

    def nearest(self, vector: tuple, k: int):
        """(similarities, entries) of the k nearest by cosine; ties go to the earlier entry."""
        parts = [(t, w) for t, w in vector if t in self.postings]
        if not parts:
            return np.zeros(0), np.zeros(0, int)
        bound = sum(w * self.highest[t] for t, w in parts)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        sims, ids, least, done, step = np.zeros(0), np.zeros(0, int), -1.0, 0, 2
        while done < len(order) and not (len(sims) == k and bound[order[done]] < least - 1e-12):
            # Blocks in steps of growing size, best bounds first; one pass over their postings each.
            some = order[done:done + step]
            some = some[bound[some] >= least - 1e-12] if len(sims) == k else some
            done, step = done + step, step * 4
            at = np.full(self.blocks, -1)
            at[some] = np.arange(len(some))
            score = np.zeros(len(some) * BLOCK)
            for t, w in parts:
                rows, values, block = self.postings[t]
                into = at[block]
                pick = into >= 0
                score[into[pick] * BLOCK + rows[pick] % BLOCK] += w * values[pick]
            hit = np.flatnonzero(score)
            sims, ids = np.append(sims, score[hit]), np.append(ids, some[hit // BLOCK] * BLOCK + hit % BLOCK)
            best = np.lexsort((ids, -np.round(sims, 12)))[:k]
            sims, ids = sims[best], ids[best]
            least = sims[-1] if len(sims) == k else -1.0
        return sims, ids

    def vote(self, vector: tuple, rate: float, k: int) -> float:
        """Share of label 1 among the neighbours, weighted by similarity, with a prior at the base rate."""
        if not vector:
            return (self.empty[1] + PRIOR_WEIGHT * rate) / (sum(self.empty) + PRIOR_WEIGHT)
        sims, ids = self.nearest(vector, k)
        votes = (self.label_counts[ids] * sims[:, None]).sum(axis=0) if len(ids) else np.zeros(2)
        return float((votes[1] + PRIOR_WEIGHT * rate) / (votes.sum() + PRIOR_WEIGHT))


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over the log-odds of a vote."""
    x = np.log(np.clip(votes, 1e-4, 1 - 1e-4) / (1 - np.clip(votes, 1e-4, 1 - 1e-4)))
    theta, design = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], 1)
    if len(set(labels)) < 2:
        return 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (labels - p) - 1e-2 * (theta - np.array([1.0, 0.0]))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return max(float(theta[0]), 0.05), float(theta[1])


def _score(vote: float, curve: tuple[float, float]) -> float:
    vote = min(max(vote, 1e-4), 1 - 1e-4)
    return 1 / (1 + math.exp(-(curve[0] * math.log(vote / (1 - vote)) + curve[1])))


def _scorer(handle, k: int):
    def run(batches):
        index, rate, curve = handle.value
        memory: dict[tuple, float] = {}
        for batch in batches:
            out = []
            for body in batch.column("body").to_pylist():
                if index is None:
                    out.append(rate)
                    continue
                vector = index.vector(body)
                if vector not in memory:
                    if len(memory) > 50_000:
                        memory.clear()
                    memory[vector] = _score(index.vote(vector, rate, k), curve)
                out.append(memory[vector])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])
    return run


def held_out(id_col: str = "doc_id", folds: int = FOLDS):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == 0, F.lit(False))


def build(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS, z_least: float = Z_LEAST, k: int = NEIGHBOURS):
    """(index or None, base rate, curve) from the training labels."""
    known = labels.select(labels["doc_id"].alias("k"), labels[label_col].cast("int").alias("label"))
    known = known.where("k is not null and label in (0, 1)").where(~held_out("k")).groupBy("k").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    # A merge join at every size: no plan that changes with the input.
    train = texts(docs, id_col, text_col).join(known.hint("merge"), F.col("doc_id") == F.col("k")).select("doc_id", "body", "label")
    train = written(train, "toxicity_train")
    count = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    total = (count.get(0, 0), count.get(1, 0))
    if not all(total):
        return None, total[1] / max(1, sum(total)), (1.0, 0.0)
    rate = total[1] / sum(total)
    index = Index(selected_terms(train, total, z_least, max_terms))
    # A share of the hash range that surely holds max_examples rows, so that few texts and no other vectors are sorted.
    least = (max_examples + 10 * math.sqrt(max_examples) + 50) / sum(total)
    drawn = train.withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id"), 33)).where(
        F.col("place") < math.ceil(min(1.0, least) * 2**31))
    vectors = drawn.mapInArrow(_vectors(index.weights), "place long, label int, terms array<binary>, weights array<double>")
    later = []
    for place, row in enumerate(vectors.orderBy("place", "label", "terms", "weights").limit(max_examples).collect()):
        vector = tuple(zip(map(bytes, row.terms), row.weights))
        later.append((vector, row.label)) if place % 4 == 3 else index.add(vector, row.label)
    index.build()
    votes = np.array([index.vote(v, rate, k) for v, _ in later])
    return index, rate, calibrate(votes, np.array([y for _, y in later], float))


def _vectors(weights: dict[bytes, float]):
    def run(batches):
        index = Index(weights)
        for batch in batches:
            rows = [index.vector(body) for body in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("label"), pa.array([[t for t, _ in v] for v in rows], pa.list_(pa.binary())),
                 pa.array([[w for _, w in v] for v in rows], pa.list_(pa.float64()))], names=["place", "label", "terms", "weights"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             k: int = NEIGHBOURS, **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    handle = docs.sparkSession.sparkContext.broadcast(build(docs, labels, id_col=id_col, text_col=text_col, k=k, **options))
    rows = texts(docs, id_col, text_col)
    scored = rows.mapInArrow(_scorer(handle, k), f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
