"""First, last and only-one operators.

Two shapes are used, both shrink a hot key before the shuffle: ``min_by``/``max_by``
aggregates combine on the map side, and ``row_number() = 1`` gets Spark's window group
limit below the exchange. Neither brings a whole group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions.calendar import period_of


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def keep_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; the order must be total within a key."""
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def _pick(df, keys, order, values, by):
    picked = df.groupBy(*keys).agg(
        by(F.struct(*[c.alias(n) for n, c in values.items()]), F.struct(*_columns(order)))
        .alias("_picked"))
    return picked.select(*keys, *[F.col(f"_picked.{n}").alias(n) for n in values])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
             values: dict[str, Column]) -> DataFrame:
    """Values of the first row per key, all taken from the same row."""
    return _pick(df, keys, order, values, F.min_by)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
            values: dict[str, Column]) -> DataFrame:
    """Values of the last row per key, all taken from the same row."""
    return _pick(df, keys, order, values, F.max_by)


def first_non_null(value: Column, order: Column) -> Column:
    """Aggregate: the value of the first row (by ``order``) that has one."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def last_non_null(value: Column, order: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order))


def repair_age(df: DataFrame, tolerance: int = 2, isolated_to_null: bool = False,
               unique_days: bool = True) -> DataFrame:
    """Replace one-day jumps of the delinquency age and fill single gaps.

    A jump is more than ``tolerance`` days off both neighbours in the same direction; it
    becomes the previous age plus one. A null between neighbours that are two apart is
    filled the same way. Adds ``prev_age``, ``next_age``, ``is_jump`` and ``age_fix``.

    The window needs the rows of one account together; with one row per account and day
    that is at most one row per calendar day. Pass ``unique_days=False`` for input that
    repeats days: the highest age of each day is taken first, combined on the map side.
    """
    if not unique_days:
        df = df.groupBy("account", "dt").agg(F.max("age").alias("age"))
    days = Window.partitionBy("account").orderBy("dt")
    neighbours = df.withColumns({"prev_age": F.lag("age").over(days), "next_age": F.lead("age").over(days)})
    return fixed_age(neighbours, tolerance, isolated_to_null)


def jumps(age: Column, before: Column, after: Column, tolerance: int = 2) -> Column:
    """Is the age more than ``tolerance`` days off both neighbours in the same direction?"""
    up = (age - before > tolerance) & (age - after > tolerance)
    down = (before - age > tolerance) & (after - age > tolerance)
    return F.coalesce(up | down, F.lit(False))


def repaired_age(age: Column, before: Column, after: Column, tolerance: int = 2) -> Column:
    """The age, jumps and single gaps replaced; see :func:`repair_age`."""
    return (F.when(jumps(age, before, after, tolerance), before + 1)
            .when(age.isNull() & (after == before + 2), before + 1).otherwise(age))


def fixed_age(df: DataFrame, tolerance: int = 2, isolated_to_null: bool = False) -> DataFrame:
    """Add ``is_jump`` and ``age_fix`` to rows that know ``prev_age`` and ``next_age``."""
    age, before, after = F.col("age"), F.col("prev_age"), F.col("next_age")
    fixed = repaired_age(age, before, after, tolerance)
    if isolated_to_null:
        fixed = F.when(before.isNull() & after.isNull(), None).otherwise(fixed)
    return df.withColumns({
        "is_jump": F.when(jumps(age, before, after, tolerance), 1).otherwise(0), "age_fix": fixed})


def dedup_interactions(contacts: DataFrame) -> DataFrame:
    """One contact per account, day and purpose: the latest."""
    return keep_one(contacts, ["account", F.to_date("start"), "purpose"],
                    [F.col("start").desc_nulls_last(), F.col("interaction_id").desc()])


def dedup_first_id(contacts: DataFrame) -> DataFrame:
    """One contact per account, day, channel, agent and purpose: the lowest id.

    The scripts this follows join the first id back to all rows, which repeats rows for
    each duplicate; keeping the row itself is what they intend.
    """
    return keep_one(contacts, ["account", F.to_date("start"), "channel", "agent", "purpose"],
                    [F.col("interaction_id").asc()])


def densest_entry_day(accounts: DataFrame, day: str = "first_day", grain: str = "month") -> DataFrame:
    """Per period the day on which most accounts entered; the earlier day wins a tie."""
    per_day = (accounts.groupBy(period_of(F.col(day), grain).alias("period"), F.col(day))
               .agg(F.count_distinct("account").alias("accounts")))
    return keep_one(per_day, ["period"], [F.desc("accounts"), F.asc(day)])


def attach_multiplicity(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Attach to each row how many rows share its key (1 when the key is null).

    Counting first and joining back keeps a hot key out of a single window partition:
    the count combines on the map side, and AQE splits or broadcasts the join. Rows with
    a null key match nothing; a hash of the row spreads them over the partitions.
    """
    null_key = F.expr(" OR ".join(f"{k} IS NULL" for k in keys))
    counts = (df.where(~null_key).groupBy(*keys).agg(F.count("*").alias(name))
              .withColumn("_spread", F.lit(0).cast("long")))
    spread = F.when(null_key, F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
    return (df.withColumn("_spread", spread).join(counts, [*keys, "_spread"], "left")
            .drop("_spread").withColumn(name, F.coalesce(name, F.lit(1))))


def rank_pairs(pairs: DataFrame, left: str = "fixed_account", right: str = "mobile_account",
               left_limit: int = 1, right_limit: int = 2) -> DataFrame:
    """Rank matches from both sides and keep the best ones.

    Each left key keeps its ``left_limit`` highest right keys; independently each right
    key keeps its ``right_limit`` highest left keys. Both ranks see all pairs, so the
    limits are part of the rule and the window group limit applies to each. What is kept has up
    to a row per key, so both sides are merged and none is broadcast.
    """
    by_left = Window.partitionBy("period", left).orderBy(F.desc(right))
    by_right = Window.partitionBy("period", right).orderBy(F.desc(left))
    good_left = (pairs.withColumn("left_rank", F.row_number().over(by_left))
                 .where(F.col("left_rank") <= left_limit))
    good_right = (pairs.withColumn("right_rank", F.row_number().over(by_right))
                  .where(F.col("right_rank") <= right_limit)
                  .select("period", left, right, "right_rank"))
    return good_left.join(good_right.hint("merge"), ["period", left, right], "inner")
