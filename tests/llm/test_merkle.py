"""Merkle manifests against a plain tree."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from abonara.llm import merkle
from abonara.llm.common import ascii_lower

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, place string, alive int, item string, "
          "leaf string, seen string, path string, c0 string")
CLASH = ("clash", "clash", 1, "clash", "clash", "clash", "clash", "clash")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def piece(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, **changes):
    return sha("".join(piece((row | changes)[c]) for c in merkle.COLUMNS))


def tree(leaves):
    paths, owners, nodes = [[] for _ in leaves], [[k] for k in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, held = [], []
        for first in range(0, len(nodes), 8):
            run = nodes[first:first + 8]
            for k in range(len(run)):
                for owner in owners[first + k]:
                    paths[owner].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            held.append(sum(owners[first:first + 8], []))
        nodes, owners = above, held
    return nodes[0], paths


def plain(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        members = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = members, *tree([leaf(r) for r in members])
    root, upper = tree([trees[g][1] for g in langs])
    for lang, above in zip(langs, upper):
        members, subroot, paths = trees[lang]
        for r, path in zip(members, paths):
            path, node = path + above, leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                node = leaf(r, text="".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for left, right in path:
                node = sha("".join(left) + node + "".join(right))
            yield (r["doc_id"], leaf(r), subroot, root, sha("".join("".join(a) + "".join(b) for a, b in path)), node, node == root)


def result(frame):
    found = merkle.verified(frame, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, {"text": ascii_lower(frame["text"])})
    return sorted((tuple(r) for r in found.collect()), key=str)


def rows(n, langs, seed=1):
    rng = random.Random(seed)
    for i in range(n):
        text = rng.choice([None, "", "Abc É", "lower only", "X" * rng.randint(1, 30), "word " * rng.randint(1, 3000)])
        yield {"doc_id": i, "text": text, "lang": rng.choice(langs), "source": rng.choice([None, "web", "-"]),
               "n_chars": None if text is None else len(text)}


def frame(spark, made):
    return spark.createDataFrame([tuple(r.values()) + CLASH for r in made], SCHEMA)


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (9, ["en"]), (64, ["en"]), (65, ["en"]), (600, ["en", None, "de", "", "é"]),
                                      (40, [f"l{k}" for k in range(20)])])
def test_manifest_equals_a_plain_tree(spark, n, langs):
    made = list(rows(n, langs))
    assert result(frame(spark, made).repartition(3)) == sorted(plain(made), key=str)


def test_null_and_repeated_ids(spark):
    made = list(rows(30, ["en", "fr"])) + [r | {"doc_id": None} for r in rows(20, ["en", None], 2)] + list(rows(3, ["en"])) * 4
    assert result(frame(spark, made)) == sorted(plain(made), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = merkle.verified(empty, F.lit(False), {})
    assert found.collect() == [] and found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
