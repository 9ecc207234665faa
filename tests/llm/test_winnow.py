"""Fingerprints against a direct version, their match guarantee, and the order of neighbours."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from abonara.llm import winnow

SCHEMA = "doc_id bigint, text string, key string, range string, body string, last boolean, size int, next string"
CLASH = ("clash", "clash", "clash", True, 1, "clash")


def direct(text, gram, window):
    """Every hash from its own run, every window searched from its right end."""
    with np.errstate(over="ignore"):
        points = [winnow.mix(np.array([ord(c)], np.uint64) * winnow.BYTE_VALUE[7])[0] for c in text]
        n = min(gram, len(points))
        if not n:
            return []
        hashes = []
        for i in range(len(points) - n + 1):
            total = np.uint64(0)
            for j in range(n):
                total += points[i + j] * np.uint64(pow(int(winnow.STEP), j, 1 << 64))
            hashes.append(int(winnow.mix(np.array([total]))[0]))
    window, chosen = min(window, len(hashes)), set()
    for i in range(len(hashes) - window + 1):
        chosen.add(min(range(i, i + window), key=lambda j: (hashes[j], -j)))
    return [(j, hashes[j]) for j in sorted(chosen)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé😀 ", max_size=90), st.integers(1, 9), st.integers(1, 12), st.sampled_from([5, 1 << 20]))
def test_fingerprint_equals_the_direct_one(text, gram, window, block):
    kept, winnow.BLOCK = winnow.BLOCK, block
    try:
        hashes, positions = winnow.fingerprint(text, gram, window)
    finally:
        winnow.BLOCK = kept
    assert list(zip(positions.tolist(), hashes.tolist())) == direct(text, gram, window)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60), st.text(max_size=60), st.text(alphabet="xyz", min_size=12, max_size=30), st.text(max_size=60))
def test_shared_passages_are_always_found(a, b, passage, c):
    """gram + window - 1 = 12 common code points: a common hash inside the passage, at its place in both."""
    one, two = winnow.fingerprint(a + passage + b, 5, 8), winnow.fingerprint(c + passage, 5, 8)
    inside = lambda found, at: {(h, p - at) for h, p in zip(found[0].tolist(), found[1].tolist()) if at <= p <= at + len(passage) - 5}
    assert inside(one, len(a)) & inside(two, len(c))


def test_packing_and_likeness():
    marks = winnow.fingerprint("some text that is long enough to have a few marks in it" * 3)
    hashes, positions = winnow.unpacked(winnow.packed(*marks))
    assert hashes.tolist() == marks[0].tolist() and positions.tolist() == marks[1].tolist()
    none = np.zeros(0, np.uint64)
    assert winnow.likeness(none, none) == 1.0 and winnow.likeness(none, marks[0]) == 0.0
    assert winnow.likeness(np.array([1, 1, 2]), np.array([2, 3])) == pytest.approx(1 / 3)


def texts():
    rng = random.Random(9)
    say = lambda n: "".join(rng.choice("abcdefg hé😀") for _ in range(n))
    rows = [(i, say(rng.choice([0, 1, 3, 4, 50, 400, 1500]))) for i in range(0, 240, 2)]
    rows += [(-5, None), (7, ""), (9, "a" * 3000), (11, rows[5][1]), (1 << 40, say(60000))]
    rng.shuffle(rows)
    return rows


def check(found, order):
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        f, e, n = (winnow.fingerprint(t) for t in (text, edited, after))
        expected = (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnow.packed(*f), winnow.packed(*e),
                    winnow.likeness(f[0], e[0]), winnow.likeness(f[0], n[0]))
        assert expected in found
        found.remove(expected)
    assert not found


@pytest.mark.parametrize("size", [1 << 23, 2000])
def test_neighbours_follow_the_order(spark, monkeypatch, size):
    monkeypatch.setattr(winnow, "RANGE_BYTES", size)
    frame = spark.createDataFrame([(i, t) + CLASH for i, t in texts()], SCHEMA).repartition(5)
    check([tuple(r) for r in winnow.neighbours(frame).collect()], sorted((i, t or "") for i, t in texts()))


def test_null_and_repeated_ids(spark, monkeypatch):
    """Equal ids are ordered by the hash of the text; rows equal in both follow each other."""
    monkeypatch.setattr(winnow, "RANGE_BYTES", 3000)
    rows = texts()[:20] + [(None, t) for _, t in texts()[20:50]] + [(4, "the same row again and again " * 4)] * 200
    frame = spark.createDataFrame([(i, t) + CLASH for i, t in rows], SCHEMA).repartition(4)
    hashed = frame.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    check([tuple(r) for r in winnow.neighbours(frame).collect()], [(r.doc_id, r.t) for r in order])


def test_edges_and_plain_fingerprints(spark):
    assert winnow.neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    only = winnow.neighbours(spark.createDataFrame([(1, "abcdefgh") + CLASH], SCHEMA)).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in only] == [(8, hashlib.sha256(b"abcdefab").hexdigest(), 1.0)]
    found = {r.doc_id: r for r in winnow.fingerprints(spark.createDataFrame([(i, t) + CLASH for i, t in texts()], SCHEMA)).collect()}
    for i, t in texts():
        hashes, positions = winnow.fingerprint(t or "")
        assert (found[i].n_chars, found[i].positions) == (len(t or ""), positions.tolist())
        assert np.array(found[i].hashes, np.int64).view(np.uint64).tolist() == hashes.tolist()
