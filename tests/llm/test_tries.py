"""Prefix tries against a plain trie, on hand-made conversations."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from abonara.llm import ranks, tries

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, depth string, length string, place string, p1 string, "
          "members string, head string, words string, words2 int")
CLASH = ("clash",) * 7 + (1,)


def conversations():
    rng = random.Random(3)
    say = lambda: " ".join(rng.choice(["hello", "yes", "no", "why not", "\t", ""]) for _ in range(rng.randint(0, 3)))
    rows = []
    opening = [("user", "good morning"), ("assistant", "how can I  help"), ("user", "my bill")]
    for conv in list(range(0, 130, 3)) + [20, 40, 1000, 1001, -7, -20]:
        turns = opening[:rng.randint(0, 3)] + [(rng.choice(["user", "assistant", None]), say()) for _ in range(rng.randint(0, 4))]
        rows += [(conv, t, r, x) for t, (r, x) in enumerate(turns or [("user", None)])]
    copied = [(t, "user", f"turn {t}") for t in range(40)]
    rows += [(conv, *t) for conv in (201, 202, 203, 204, 205) for t in copied[:40 - conv % 3]]
    rows += [(300, t, "user", "again") for t in range(25)] + [(301, None, "user", "late"), (301, None, "bot", "late"), (301, 5, None, None)]
    rows += [(None, 0, "user", "lost"), (303, 1, "user", "twice"), (303, 1, "user", "twice"), (303, 1, "user", "word " * 5000)]
    rng.shuffle(rows)
    return rows


def build(frame):
    turns, convs = tries.turns_of(frame)
    conv = F.col("conv_id")
    return tries.trie(*tries.rebuilt(turns, convs, F.crc32(conv.cast("string")) % 4, conv - conv % 20, 3))


def tie(row):
    """Rows of one turn number are ordered by a hash, which a plain version cannot know: take them as given."""
    return row["turn"] is not None, row["turn"] or 0, row["place"]


def plain(rows):
    own = collections.defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            own[r["conv_id"]].append(r)
    for conv, turns in own.items():
        own[conv] = [(r["role"] or "", r["text"] or "") for r in sorted(turns, key=tie)]
    paths = {}
    for conv in list(own):
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        paths[conv] = tuple(own.get(base, [])[:h] + own[conv][h:])
    members, kids = collections.defaultdict(list), collections.defaultdict(list)
    for conv, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in kids[path])
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if paths[c] == p)
    return sorted((len(p), min(m), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items())


def result(frame):
    return sorted((r.depth, r.conv_id, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in build(frame).collect())


def ordered(spark, frame):
    """The rows with the places that the operator gives to ties."""
    key = lambda r: (r["conv_id"], r["turn"], r["role"] or "", r["text"] or "")
    hashed = frame.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"t1": F.xxhash64(F.lit(1), "role", "text"), "t2": F.xxhash64(F.lit(2), "text", "role")}).collect()
    return [r.asDict() | {"place": (r["t1"], r["t2"])} for r in sorted(hashed, key=lambda r: str(key(r)))]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([r + CLASH for r in conversations()], SCHEMA)


def test_trie_equals_a_plain_one(spark, frame):
    assert result(frame) == plain(ordered(spark, frame))


def test_blocks_and_a_full_sketch_change_nothing(spark, frame, monkeypatch):
    expected = result(frame)
    monkeypatch.setattr(ranks, "BLOCK", 3)
    monkeypatch.setattr(tries, "MIN_CELLS", 64)
    turns, convs = tries.turns_of(frame)
    conv = F.col("conv_id")
    found = tries.trie(*tries.rebuilt(turns, convs, F.crc32(conv.cast("string")) % 4, conv - conv % 20, 3), max_cells=64)
    assert sorted((r.depth, r.conv_id, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in found.collect()) == expected


def test_sketch_never_counts_too_low(spark, frame):
    turns, convs = tries.turns_of(frame)
    conv = F.col("conv_id")
    rows = tries.prefixes(tries.rebuilt(turns, convs, F.lit(0), conv, 3)[0])
    cells = 1 << 10
    alone = tries._alone(spark, tries.sketch(rows, cells), cells)
    proved = rows.groupBy("depth", "p1", "p2").count().withColumn("alone", alone("p1", "p2"))
    assert proved.where("alone AND count > 1").count() == 0
    assert proved.where("alone").count() > proved.where("count = 1").count() / 2


def test_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert result(spark.createDataFrame([], schema)) == []
    assert result(spark.createDataFrame([(None, 1, "user", "x")], schema)) == []
    lone = result(spark.createDataFrame([(20, 1, "user", "only one")], schema))
    assert [(r[0], r[1], r[3], r[4], r[5], r[6]) for r in lone] == [(0, 20, 1, 1, 1, 0), (1, 20, 1, 0, 1, 0)]
    # Conversation 1 forks after more turns than it or its absent base has: a member without turns.
    h = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    empty = result(spark.createDataFrame([(h, 1, "user", "gone")], schema))
    assert empty == [(0, h, None, 1, 0, 1, 0, hashlib.sha256(str(h).encode()).hexdigest())]


def test_a_hot_conversation_is_dealt_over_tasks(spark):
    frame = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("g"), F.col("id").alias("v"))
    placed, groups = ranks.places(frame, ["g"], [F.col("v").desc()], "hot")
    rows = placed.where("g = 7").orderBy(F.desc("v")).collect()
    assert [r.place for r in rows] == list(range(len(rows)))
    assert {r.g: r.members for r in groups.collect()}[7] == len(rows)
    assert "rangepartitioning" in frame.repartitionByRange("g", "v")._jdf.queryExecution().executedPlan().toString()
