"""Trie of conversation prefixes: how many conversations share each beginning.

Conversations are first rebuilt as forks: conversation ``c`` starts with the first ``h`` turns of
its base (see :func:`rebuilt`). Every prefix of a rebuilt conversation gets a 128-bit digest: the
exclusive or of hashes of (depth, turn), so a prefix extends the one before it by one step.

Count-min screening. A sketch counts prefix digests (four rows of cells, saturating at two, size
from the number of turns up to ``max_cells``). It never counts too low: an estimate of one proves
that a single conversation has the prefix, so everything below it belongs to that conversation
alone and is emitted where it stands. Only prefixes whose parent may be shared are grouped exactly,
by depth and digest. What the sketch overestimates is merely grouped although it was alone.

Sums over subtrees need no walk by depth. The smallest member owns a node; a conversation owns the
nodes from some depth downwards. So a subtree's sum is the running sum along the owner plus the
totals of the other owners that pass through the node: one aggregate over their prefixes.

Rows without ``conv_id`` belong to no conversation and are left out. Turns ascend, null first; rows
that tie are ordered by a hash of role and text. A null role or text is empty; repeated rows are
turns of their own; an empty table gives no nodes. Texts are hashed where they are read and never
shuffled, whatever their length. A conversation of any length is dealt over tasks by range. The list
behind ``ends_sha256`` is hashed as a stream, since SHA-256 cannot be taken in parts. Two different
prefixes of one depth are told apart but for a chance of 2^-128 a pair. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import mix, n_words, written
from abonara.llm.ranks import places, running

SKETCH_ROWS = 4
#: Cells of a sketch row: twice the turns, as a power of two within these bounds.
MIN_CELLS, MAX_CELLS = 1 << 12, 1 << 25
_SHARD = 1 << 16
KEY = ["depth", "p1", "p2"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), hash of the turn in two numbers, words; and conversations with their lengths."""
    text = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(""))
    role, body = text("role"), text("text")
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].alias("turn"),
        F.xxhash64(F.lit(1), role, body).alias("t1"), F.xxhash64(F.lit(2), body, role).alias("t2"), n_words(body).alias("words"))
    return places(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")], "trie_turns")


def rebuilt(turns: DataFrame, convs: DataFrame, fork: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Each conversation as the first ``fork`` turns of its ``base`` and its own turns after as many.

    ``fork`` (at most ``most``) and ``base`` are columns of conv_id. A base with fewer turns gives
    all it has, an absent one none. Returns the turns (conv_id, depth from 1, length, turn, words)
    and the conversations (conv_id, length), also those without a turn.
    """
    turn = F.struct("place", "t1", "t2", "words")
    heads = (turns.where(F.col("place") < most).groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(turn)).alias("head")))  # at most ``most`` turns
    forks = convs.select("conv_id", F.col("members").alias("own"), fork.cast("int").alias("h"), base.alias("base"))
    forks = forks.join(heads, "base", "left").select(
        "conv_id", "own", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head"))
    forks = forks.withColumn("taken", F.size("head")).withColumn(
        "length", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long"))
    first = forks.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), "length", "t.t1", "t.t2", "t.words")
    about = forks.select("conv_id", "length", (F.col("taken") - F.col("h")).alias("shift"))
    own = turns.where(F.col("place") >= fork).join(about, "conv_id").select(
        "conv_id", (F.col("place") + 1 + F.col("shift")).alias("depth"), "length", "t1", "t2", "words")
    return first.unionByName(own), forks.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds the digest of the prefix that ends with each turn (p1, p2) and of the one before (q1, q2)."""
    step = {f"s{k}": F.xxhash64(F.lit(k), F.col("depth"), F.col("t1"), F.col("t2")) for k in (1, 2)}
    rows = turns.withColumns(step)
    rows = running(rows, "conv_id", "depth", {"p1": F.col("s1"), "p2": F.col("s2")}, F.bit_xor)
    return rows.select("conv_id", "depth", "length", "words", "p1", "p2",
                       *[F.col(f"p{k}").bitwiseXOR(F.col(f"s{k}")).alias(f"q{k}") for k in (1, 2)])


def _cells(p1: np.ndarray, p2: np.ndarray, row: int, cells: int) -> np.ndarray:
    h = mix(p1.view(np.uint64) + p2.view(np.uint64) * np.uint64(2 * row + 1))
    return (h >> np.uint64(32)).astype(np.int64) & (cells - 1)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _partial_sketch(cells: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((SKETCH_ROWS, cells), np.uint8)
        for batch in batches:
            p1, p2 = _numbers(batch, "p1", "p2")
            for row in range(SKETCH_ROWS):
                at, many = np.unique(_cells(p1, p2, row, cells), return_counts=True)
                counts[row, at] = np.minimum(counts[row, at] + np.minimum(many, 2), 2)
        flat = counts.reshape(-1)
        for shard, first in enumerate(range(0, len(flat), _SHARD)):
            part = flat[first:first + _SHARD]
            if part.any():
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), **{
                    n: pa.array([np.packbits(part >= k).tobytes()], pa.binary()) for n, k in (("once", 1), ("twice", 2))}})
    return build


def _merge_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by shard; one shard is held at a time."""
    held, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict({"shard": pa.array([held], pa.int32()), "twice": pa.array([twice.tobytes()], pa.binary())})

    for batch in batches:
        for shard, a, b in zip(*(batch.column(k).to_pylist() for k in range(3))):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            if shard != held:
                if held is not None:
                    yield done()
                held, once, twice = shard, a.copy(), b.copy()
            else:
                twice |= b | (once & a)
                once |= a
    if held is not None:
        yield done()


def sketch(rows: DataFrame, cells: int) -> bytes:
    """One bit a cell: was it met twice? ``SKETCH_ROWS * cells / 8`` bytes, however large the table.

    Each task sends its own cells in pieces; pieces are merged by tasks, and the merged sketch, 16 MB
    at ``MAX_CELLS``, goes through the driver to the workers.
    """
    parts = rows.select("p1", "p2").mapInArrow(_partial_sketch(cells), "shard int, once binary, twice binary")
    merged = (parts.repartition("shard").sortWithinPartitions("shard")
              .mapInArrow(_merge_sketches, "shard int, twice binary"))
    bits = bytearray(SKETCH_ROWS * cells // 8)
    size = min(_SHARD, SKETCH_ROWS * cells) // 8
    for part in merged.collect():  # bounded by ``cells``
        bits[part.shard * size:part.shard * size + len(part.twice)] = part.twice
    return bytes(bits)


def _alone(spark, bits: bytes, cells: int):
    """Column function: does the sketch prove that a prefix belongs to one conversation?"""
    sent = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def alone(p1: pd.Series, p2: pd.Series) -> pd.Series:
        table = np.frombuffer(sent.value, np.uint8)
        a, b, proved = p1.to_numpy(), p2.to_numpy(), np.zeros(len(p1), bool)
        for row in range(SKETCH_ROWS):
            at = _cells(a, b, row, cells) + row * cells
            proved |= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
        return pd.Series(proved)
    return alone


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation to one hash per node, without holding the list."""
    held, state = None, None

    def done():
        return pa.RecordBatch.from_pydict({
            "depth": pa.array([held[0]], pa.int64()), "p1": pa.array([held[1]], pa.int64()),
            "p2": pa.array([held[2]], pa.int64()), "ends": pa.array([state.hexdigest()])})

    for batch in batches:
        for *key, conv in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if key != held:
                if held is not None:
                    yield done()
                held, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
    if held is not None:
        yield done()


def _hash_of(conv: Column) -> Column:
    return F.sha2(conv.cast("string"), 256)


def trie(turns: DataFrame, convs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Per distinct prefix of the conversations: owner, depth, parent's owner, counts and sums of its subtree.

    ``turns`` and ``convs`` as :func:`rebuilt` returns them.
    """
    spark, none = turns.sparkSession, F.sha2(F.lit(""), 256)
    rows = written(prefixes(turns), "trie_prefixes")
    n = rows.count()
    cells = min(max(1 << (2 * n - 1).bit_length() if n else 0, MIN_CELLS), max_cells)
    alone = _alone(spark, sketch(rows, cells), cells)
    # The root is the parent of depth 1 and always grouped; below it the sketch decides.
    screened = rows.withColumn("tail", (F.col("depth") > 1) & alone("q1", "q2"))
    tails = screened.where("tail").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("depth") < F.col("length"), 1).otherwise(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") < F.col("length"), none).otherwise(_hash_of(F.col("conv_id"))).alias("ends_sha256"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), "length", *[zero.alias(c) for c in ("words", "p1", "p2", "q1", "q2")])
    shared = written(screened.where("NOT tail").drop("tail").unionByName(roots), "trie_shared")

    ends = F.col("depth") == F.col("length")
    nodes = written(shared.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count(F.when(ends, 1)).alias("n_ends"),
        F.min(F.when(ends, F.col("conv_id"))).alias("end"), F.max("words").alias("words"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")), "trie_nodes")
    # A root of one conversation has no parent that would hand it down, so it counts as shared.
    many = nodes.where("n_convs > 1 OR depth = 0")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    below = nodes.where("depth > 0").select(*parent, "n_convs").groupBy(*KEY).agg(
        F.count("*").alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("single_children"))
    inner = many.join(below, KEY, "left").fillna(0, ["n_children", "single_children"]).withColumns({
        "own_leaves": F.col("single_children") + F.when(F.col("n_children") == 0, 1).otherwise(0),
        "own_saved": (F.col("n_convs") - 1) * F.col("words")})
    inner = written(running(inner, "conv_id", "depth", {
        "leaves_down": F.col("own_leaves"), "saved_down": F.col("own_saved")}, F.sum, backward=True), "trie_inner")

    # What an owner has below the node where it leaves a smaller conversation's path counts for that path too.
    owners = inner.groupBy("conv_id").agg(
        F.min("depth").alias("from"), F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved")).where("from > 0")
    passing = shared.select("conv_id", *KEY).join(owners, "conv_id").where(F.col("depth") < F.col("from")).groupBy(*KEY).agg(
        F.sum("leaves").alias("other_leaves"), F.sum("saved").alias("other_saved"))
    listed = (shared.where(ends).select(*KEY, "conv_id")
              .join(nodes.where("n_ends > 1").select(*KEY), KEY, "left_semi").select(*KEY, "conv_id")
              .repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(_hash_ends, "depth long, p1 long, p2 long, ends string"))
    sums = (inner.select(*KEY, "n_children", "leaves_down", "saved_down").join(passing, KEY, "left")
            .select(*KEY, "n_children", (F.col("leaves_down") + F.coalesce("other_leaves", zero)).alias("n_leaves"),
                    (F.col("saved_down") + F.coalesce("other_saved", zero)).alias("saved_tokens")))
    above = inner.select(F.col("depth").alias("a0"), F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("conv_id").alias("above"))
    is_parent = (F.col("a0") == F.col("depth") - 1) & (F.col("a1") == F.col("q1")) & (F.col("a2") == F.col("q2"))
    grouped = nodes.join(sums, KEY, "left").join(listed, KEY, "left").join(above, is_parent, "left")
    # A node of one conversation: one way down. Its parent is shared, or the same conversation's.
    single = F.col("n_leaves").isNull()
    return grouped.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(single, F.when(F.col("n_ends") == 0, 1).otherwise(0)).otherwise(F.col("n_children")).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.when(F.col("n_ends") == 0, none).when(F.col("n_ends") == 1, _hash_of(F.col("end"))).otherwise(F.col("ends")).alias("ends_sha256"),
    ).unionByName(tails)
