"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. The rates that meet the sources' token targets with the least
relative entropy are exponential tilts of the size, exp(multiplier of the source x size), here
with the rate bounded by ``cap``. The dual is convex; its constraints do not share documents, so
the Hessian is diagonal. Each safeguarded Newton round is one aggregate over the histogram (source,
size, documents): gap and slope of every source, combined before the shuffle; between rounds only
the multipliers, one a source, are on the driver.

Rates become copies by systematic rounding along the sizes of a source: documents of like size
share the rounding, so the words taken stay within about one document of the target. The running
sums live on the histogram; documents of one source and size are placed by a range sort of thin
rows (see ``ranks``), so neither a hot source nor a hot size meets in one task. The order is by id,
then by a hash of the text, hence reruns agree; only rows equal in both may change places. Repeated
rows are separate documents.

Nulls and empty texts have size 0 and are taken by rate like any other (they add no words). A null
source is a source of its own and comes last. Very long texts are counted where they are read. An
empty table gives an empty result; other columns than those named are not read.
"""

from __future__ import annotations

from uuid import uuid4

import numpy as np
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from abonara.llm.common import n_words, numbered, written
from abonara.llm.ranks import places

CAP = 3.0
_TIE = "_text_1d0b6f"  # a name that no table has


def waterfill(size: list[int], weight: list[float], cap: float) -> list[float]:
    """Share the total of ``size`` by weight; nothing above ``cap`` times its size, excess reshared."""
    target, free = [0.0] * len(size), set(range(len(size)))
    left = float(sum(size))
    while free:
        unit = left / sum(weight[k] for k in free)
        over = [k for k in free if weight[k] * unit > cap * size[k]]
        if not over:
            for k in free:
                target[k] = weight[k] * unit
            break
        for k in over:
            target[k] = cap * size[k]
            left -= target[k]
            free.discard(k)
    return target


def targets(sizes: DataFrame, weights=(1, 2, 3), cap: float = CAP) -> DataFrame:
    """source, source_size, target: one row per source, sources by code point with null last.

    Sources are named, not counted by documents, so their list is small beside the data; the
    levels of the water-filling depend on all of them together.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    rows = sorted(rows, key=lambda r: (r.source is None, [ord(c) for c in r.source or ""]))
    cuts = waterfill([r.source_size for r in rows], [weights[k % len(weights)] for k in range(len(rows))], cap)
    data = [(r.source, r.source_size, t) for r, t in zip(rows, cuts)]
    return sizes.sparkSession.createDataFrame(data, "source string, source_size bigint, target double")


ROUNDS = 100


def _step(s: dict, taken: float, slope: float, cap: float) -> None:
    """One safeguarded Newton step of one source's multiplier; the bracket is unbounded at first."""
    gap = taken - s["target"]
    if abs(gap) <= 1e-9 * s["target"]:
        s["done"] = True
        return
    m = s["m"]
    s["low"], s["high"] = (m, s["high"]) if gap < 0 else (s["low"], m)
    step = m - gap / slope if slope > 0 else m
    if not s["low"] < step < s["high"] or step == m:
        wide = [x for x in (s["low"], s["high"]) if abs(x) != np.inf]
        step = sum(wide) / 2 if len(wide) == 2 else m + (2.0 if gap < 0 else -2.0) * max(1.0, abs(m))
    # A multiplier beyond the numbers that matter: the target is met as nearly as the cap allows.
    s["m"], s["done"] = step, abs(step) > 1e9 or abs(step - m) <= 1e-15 * abs(m)


def multipliers(counted: DataFrame, goal: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, mean, tilt): the multiplier of each source that meets its target.

    ``counted`` is the histogram (source, size, n). Each round is one aggregate over it, which finds
    the taken words and their slope of every source; only these, two numbers a source, pass the
    driver, which steps all multipliers at once.
    """
    spark, size = counted.sparkSession, F.col("size").cast("double")
    seen = {r.source: r for r in counted.groupBy("source").agg(
        F.sum(size * F.col("n")).alias("total"), F.sum(F.when(size > 0, F.col("n"))).alias("docs"),
        F.min(F.when(size > 0, size)).alias("least")).collect()}
    state = {}
    for r in goal.collect():
        own = seen[r.source]
        s = {"m": 0.0, "low": -np.inf, "high": np.inf, "target": r.target, "done": False, "mean": (own.total / own.docs) if own.total else 1.0}
        if not own.total or r.target <= 0:
            s |= {"m": -np.inf if own.total else 0.0, "done": True}
        elif r.target >= cap * own.total * (1 - 1e-12):
            s |= {"m": np.log(cap) * s["mean"] / own.least, "done": True}
        state[r.source] = s
    schema = "of string, mean double, tilt double"
    for _ in range(ROUNDS):
        open_ = [(k, s["mean"], s["m"]) for k, s in state.items() if not s["done"]]
        if not open_:
            break
        # One row per source: as small as the list of sources.
        tried = F.broadcast(spark.createDataFrame(open_, schema))
        x, mass = size / F.col("mean"), F.col("n") * size
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
        sums = counted.join(tried, F.col("source").eqNullSafe(F.col("of"))).groupBy("source").agg(
            F.sum(mass * F.least(rate, F.lit(cap))).alias("taken"),
            F.sum(F.when(rate < cap, mass * x * rate).otherwise(0.0)).alias("slope"))
        for r in sums.collect():
            _step(state[r.source], r.taken, r.slope, cap)
    # Sums of doubles may differ in the last digits between runs; the rounded multiplier does not.
    return spark.createDataFrame([(k, s["mean"], float(f"{s['m']:.11g}")) for k, s in state.items()], schema)


def rates(sizes: DataFrame, goal: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, size) -> documents n, source_size, target and the rate of each document."""
    counted = written(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing_histogram")
    tilts = multipliers(counted, goal, cap)
    with_goal = counted.join(goal, counted["source"].eqNullSafe(goal["source"])).select(
        counted["source"], "size", "n", "source_size", "target")
    tilted = with_goal.join(tilts, F.col("source").eqNullSafe(F.col("of")))
    exponent = F.when(F.col("size") > 0, F.col("tilt") * F.col("size") / F.col("mean")).otherwise(0.0)
    return tilted.select("source", "size", "n", "source_size", "target",
                         F.least(F.exp(F.least(exponent, F.lit(50.0))), F.lit(cap)).alias("rate"))


def copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=(1, 2, 3), cap: float = CAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, rate, copies and ``taken`` words.

    ``keep``: further columns of ``docs`` to carry (their names stay); they break ties of the id.
    """
    text = docs[text_col].cast("string")
    sizes = written(docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), n_words(text).alias("size"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias(_TIE), *[docs[c] for c in keep]), "mixing_sizes")
    goal = targets(sizes, weights, cap)
    rate = rates(sizes, goal, cap)
    # One row per source and distinct size, whatever the number of documents.
    before = W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    groups = rate.withColumn("mass_before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(before), F.lit(0.0)))
    placed, _ = places(sizes, ["source", "size"], [F.xxhash64("doc_id"), F.col("doc_id"), F.col(_TIE), *[F.col(c) for c in keep]], "mixing_places")
    joined = placed.alias("d").join(groups.alias("g"), F.expr("d.source <=> g.source and d.size = g.size")).select(
        "d.*", "g.source_size", "g.target", "g.rate", "g.mass_before")
    upto = lambda k: F.floor(F.col("mass_before") + k * F.col("rate") + F.lit(0.5 + 1e-9))
    taken = joined.withColumn("copies", F.least(F.lit(int(cap)), upto(F.col("place") + 1) - upto(F.col("place"))).cast("int"))
    return taken.withColumn("taken", F.col("size") * F.col("copies")).drop("place", "mass_before", _TIE)


def mixed(docs: DataFrame, *, id_col: str = "doc_id", row_col: str | None = None, **options) -> DataFrame:
    """The mix itself: each row as often as its own copies, with the columns of ``docs``.

    ``row_col``: a column that names each row; without it the rows are numbered here.
    """
    number, row, many, copy = (f"_{uuid4().hex}" for _ in range(4))  # names that no table has
    rows = docs if row_col else numbered(docs, number)
    row_col = row_col or number
    chosen = copies(rows, id_col=id_col, keep=(row_col,), **options).where("copies > 0").select(
        F.col(row_col).alias(row), F.col("copies").alias(many))
    rows = rows.join(chosen, F.col(row_col) == F.col(row))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(many)))).select(docs.columns)
