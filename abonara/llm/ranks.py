"""Places of rows in an order, and running totals along it, without one task per group.

A window over a group needs the whole group in one task. Here the rows are sorted by range, so a
hot group spreads over many tasks; the totals of the pieces (a row per group and task, or per
group and block) carry what came before into each piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abonara.llm.common import written

#: Rows of a group that one window sees at most in :func:`running`.
BLOCK = 4096


def places(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``place`` (from 0 in each group's order), and one row per group with ``members``.

    Nulls are a group of their own. Rows that tie are dealt by a row number; the caller's order
    leaves only rows tied that may change places. The sorted rows are written once, as their
    places must not change. Columns named ``place`` or ``members`` must not be in ``rows``.
    """
    spot, tie, part, shift = (f"_{uuid4().hex}" for _ in range(4))
    sorts = [F.col(g).asc_nulls_first() for g in group] + list(order) + [F.col(tie)]
    tied = rows.withColumn(tie, F.monotonically_increasing_id())
    kept = written(tied.repartitionByRange(*sorts).sortWithinPartitions(*sorts).drop(tie)
                   .withColumn(spot, F.monotonically_increasing_id()), name)
    # The upper bits of the number are the task, the lower ones the row inside it.
    task = F.shiftright(spot, 33)
    pieces = kept.groupBy(task.alias(part), *group).agg(F.min(spot).alias("first"), F.count("*").alias("many"))
    upto = Window.partitionBy(*(group or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = {g: f"_{uuid4().hex}" for g in group}
    carried = pieces.select(
        F.col(part), *[F.col(g).alias(k) for g, k in keys.items()],
        (F.coalesce(F.sum("many").over(upto), F.lit(0)) - F.col("first")).alias(shift))
    match = F.shiftright(spot, 33) == F.col(part)
    for g, k in keys.items():
        match = match & F.col(g).eqNullSafe(F.col(k))
    placed = kept.join(carried, match).select(*rows.columns, (F.col(spot) + F.col(shift)).alias("place"))
    return placed, pieces.groupBy(*group).agg(F.sum("many").alias("members"))


def running(rows: DataFrame, key: str, order: str, totals: dict[str, Column], total: Callable[[Column], Column],
            backward: bool = False) -> DataFrame:
    """Add running totals along the whole-number column ``order`` of each ``key``.

    ``total`` is an aggregate that can be taken in parts (sum, bitwise xor); ``totals`` names the
    values. Windows see a block of ``BLOCK`` numbers; later blocks add the totals of those before
    them, of which a key has one row each. Keys and numbers are not null.
    """
    block, there, where = (f"_{uuid4().hex}" for _ in range(3))
    rows = rows.withColumn(block, F.floor(F.col(order) / BLOCK))
    direction = (lambda c: F.col(c).desc()) if backward else (lambda c: F.col(c).asc())
    inside = Window.partitionBy(key, block).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(there).orderBy(direction(where)).rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: f"_{uuid4().hex}" for n in totals}
    pieces = rows.groupBy(F.col(key).alias(there), F.col(block).alias(where)).agg(
        *[total(v).alias(n) for n, v in totals.items()])
    pieces = pieces.select(there, where, *[total(F.col(n)).over(before).alias(c) for n, c in carried.items()])
    # A key of a single block carries nothing, so its row is not joined.
    pieces = pieces.where(" OR ".join(f"{c} IS NOT NULL" for c in carried.values()))
    local = rows.select("*", *[total(v).over(inside).alias(f"{c}l") for v, c in zip(totals.values(), carried.values())])
    joined = local.join(pieces, (F.col(key) == F.col(there)) & (F.col(block) == F.col(where)), "left")
    combine = lambda c: F.coalesce(total_of_two(total, F.col(f"{c}l"), F.col(c)), F.col(f"{c}l"))
    return joined.select(*[F.col(c) for c in rows.columns if c != block], *[combine(c).alias(n) for n, c in carried.items()])


def total_of_two(total: Callable[[Column], Column], a: Column, b: Column) -> Column:
    """Join two partial totals; null when one is missing."""
    return a.bitwiseXOR(b) if total is F.bit_xor else a + b
