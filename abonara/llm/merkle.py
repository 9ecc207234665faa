"""Merkle manifest of a dataset: a tree of hashes per group, their roots under one root.

Slot pivot. The nodes of a level are numbered; node ``i`` is child ``i % FANOUT`` of parent
``i / FANOUT``. Conditional aggregates spread the children of a parent into ``FANOUT`` columns;
the columns joined together, hashed, are the parent, and the columns without a child's own are its
siblings. So a level is one aggregate over rows that shrink by the fanout, and the way back down
is one join of a level with the level above it: a parent hands its children the proof from itself
to the root. No group is collected, no window runs over a group (places come from ``ranks``).

A leaf is the hash of the columns of a row, each as ``-`` for null, else its number of UTF-8 bytes,
a colon and its value. Leaves of a group ascend by id (null first, then by leaf; equal leaves may
change places). While a tree has several nodes, every ``FANOUT`` consecutive ones, the last ones
even if fewer, become their hash; a lone leaf is its own root. The roots of the groups, in order of
the group's value (null first, by bytes), are the leaves of the upper tree.

Nulls: a null group is a group. Empty texts hash as ``0:``. Repeated rows are leaves of their own.
An empty table gives an empty manifest. Very long texts are hashed in place and not shuffled.
Columns other than the named ones are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonara.llm.common import written
from abonara.llm.ranks import places

FANOUT = 8
_SLOTS = [f"c{k}" for k in range(FANOUT)]


def _piece(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[_piece(v) for v in values]), 256)


def _digests(upto: int = FANOUT, after: int = 0) -> list[Column]:
    return [F.col(f"{c}.digest") for c in _SLOTS[after:upto]]


def _parents(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, place, alive, item) to their parents, the items of the children in slots."""
    slot = F.pmod("place", F.lit(FANOUT))
    spread = [F.max(F.when(slot == k, F.col("item"))).alias(c) for k, c in enumerate(_SLOTS)]
    return (nodes.where("alive > 1").groupBy("tree", F.expr(f"place div {FANOUT}").alias("above"), "alive").agg(*spread)
            .select("tree", F.col("above").alias("place"), F.ceil(F.col("alive") / FANOUT).alias("alive"), *_SLOTS,
                    F.sha2(F.concat_ws("", *_digests()), 256).alias("digest")))


def _climb(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Every level above ``nodes``; ``most`` is the size of the largest tree."""
    levels = []
    while most > 1:
        levels.append(written(_parents(nodes), f"{name}_{len(levels)}"))
        nodes = levels[-1].select("tree", "place", "alive", F.struct("digest").alias("item"))
        most = -(-most // FANOUT)
    return levels


def _descend(levels: list[DataFrame], roots: DataFrame) -> DataFrame | None:
    """The lowest level of parents, each with its ``path`` of siblings up to the root.

    ``roots`` has tree, path (what lies above the tree) and subroot, one row per tree.
    """
    down, blank = None, [F.lit(None).cast("struct<digest:string>").alias(c) for c in _SLOTS]
    for level in reversed(levels):
        # The parent of a tree's last node is the tree itself, at place -1.
        parents = roots.select("tree", F.lit(-1).cast("long").alias("place"), *blank, "path", "subroot")
        if down is not None:
            thin = [F.struct(F.col(f"{c}.digest").alias("digest")).alias(c) for c in _SLOTS]
            parents = parents.unionByName(down.select("tree", "place", *thin, "path", "subroot"))
        ends = F.col("alive") == 1
        children = level.withColumns({
            "above": F.when(ends, -1).otherwise(F.expr(f"place div {FANOUT}")), "slot": F.pmod("place", F.lit(FANOUT))})
        parents = parents.select(F.col("tree").alias("in_tree"), F.col("place").alias("of"), "path", "subroot",
                                 *[F.col(c).alias(f"p{c}") for c in _SLOTS])
        joined = children.join(parents, (F.col("tree") == F.col("in_tree")) & (F.col("above") == F.col("of")))
        step = F.struct(*[
            F.concat_ws("", *[F.when(keep(k), F.col(f"p{c}.digest")) for k, c in enumerate(_SLOTS)]).alias(side)
            for side, keep in (("left", lambda k: F.lit(k) < F.col("slot")), ("right", lambda k: F.lit(k) > F.col("slot")))])
        path = F.when(ends, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
        down = joined.select(*level.columns, path.alias("path"), "subroot")
    return down


def _children(parents: DataFrame) -> DataFrame:
    """The children in the slots as rows, each with its own path."""
    one = lambda k, c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("item"), F.struct(
        F.concat_ws("", *_digests(k)).alias("left"), F.concat_ws("", *_digests(after=k + 1)).alias("right")).alias("step")))
    rows = parents.select("path", "subroot", F.explode(F.array(*[one(k, c) for k, c in enumerate(_SLOTS)])).alias("child"))
    return rows.where("child is not null").select(
        "child.item", F.concat(F.array("child.step"), F.col("path")).alias("path"), "subroot")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _trees(leaves: DataFrame, most: int, roots_of, name: str) -> DataFrame:
    """Leaves (tree, place, alive, item) with path and subroot; ``roots_of`` turns roots into paths."""
    levels = _climb(leaves, most, name)
    lone = leaves.where("alive = 1")
    tops = lone.select("tree", F.col("item.digest").alias("digest"))
    for level in levels:
        tops = tops.unionByName(level.where("alive = 1").select("tree", "digest"))
    roots = roots_of(tops)
    single = lone.join(roots, "tree").select("item", "path", "subroot")
    lowest = _descend(levels, roots)
    return single if lowest is None else single.unionByName(_children(lowest))


def manifest(leaves: DataFrame, group: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per leaf: id, leaf, seen, subroot, root, path (siblings from the leaf's level to the root).

    ``leaves`` has the group, the id, ``leaf`` and ``seen``, the leaf as found now (the same where
    nothing changed); :func:`folded` of ``seen`` over ``path`` tells whether it still leads to the root.
    """
    spark = leaves.sparkSession
    rows = leaves.select(F.col(group).cast("string").alias("part"), F.col(id_col).alias("id"), "leaf", "seen")
    placed, groups = places(rows, ["part"], [F.col("id").asc_nulls_first(), F.col("leaf")], "merkle_leaves")
    ranked, _ = places(groups, [], [F.col("part").asc_nulls_first()], "merkle_groups")
    size = ranked.agg(F.count("*").alias("trees"), F.max("members").alias("most")).first()
    if not size["trees"]:
        return rows.select(F.col("id").alias(id_col), "leaf", "seen", F.lit("").alias("subroot"), F.lit("").alias("root"),
                           F.lit(None).cast("array<struct<left:string,right:string>>").alias("path"))
    trees = ranked.select(F.col("part").alias("of_part"), F.col("place").alias("tree"), F.col("members").alias("alive"))
    items = placed.join(trees, F.col("part").eqNullSafe(F.col("of_part"))).select(
        "tree", "place", "alive", F.struct(F.col("leaf").alias("digest"), "id", "seen").alias("item"))
    root = []

    def above(tops: DataFrame) -> DataFrame:
        """Paths from the groups' roots to the root: a tree of its own, tree 0."""
        upper = written(tops.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(size["trees"]).cast("long").alias("alive"),
            F.struct("digest", "tree").alias("item")), "merkle_roots")

        def end(last: DataFrame) -> DataFrame:
            root.append(last.first()["digest"])
            return last.select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                               F.col("digest").alias("subroot"))

        ways = _trees(upper, size["trees"], end, "merkle_upper")
        return written(ways.select("item.tree", "path", F.col("item.digest").alias("subroot")), "merkle_ways")

    found = _trees(items, size["most"], above, "merkle")
    return found.select(F.col("item.id").alias(id_col), F.col("item.digest").alias("leaf"), "item.seen", "subroot",
                        F.lit(root[0]).alias("root"), "path")


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def verified(docs: DataFrame, changed: Column, changes: dict[str, Column]) -> DataFrame:
    """The manifest of documents; rows where ``changed`` holds are read with ``changes`` to their columns.

    ``folded_root`` is where the row as read leads to, ``verified`` whether that is still the root.
    """
    values = {c: docs[c] for c in COLUMNS}
    leaf, now = leaf_hash(list(values.values())), leaf_hash(list((values | changes).values()))
    leaves = docs.select(docs["doc_id"], docs["lang"], leaf.alias("leaf"), F.when(changed, now).otherwise(leaf).alias("seen"))
    found = manifest(leaves)
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
                        folded(F.col("seen"), F.col("path")).alias("folded_root")
                        ).withColumn("verified", F.col("folded_root") == F.col("root"))
