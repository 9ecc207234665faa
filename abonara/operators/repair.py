"""Repair of the delinquency age period by period.

The rule asks for the ages on the record before and after, which may lie in other periods. Each
period therefore gives its first and last record per account as an *edge*; the neighbours of a
period are found among edges, one thin row per account and period, and only the days of the period
itself are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from abonara.functions.calendar import period_of
from abonara.operators import partials
from abonara.operators.dedup import fixed_age


def edge_facts() -> dict[str, partials.Fact]:
    age, day = F.col("age"), F.col("dt")
    return {"first_dt": partials.lowest(day), "first_age": partials.first(age, day),
            "last_dt": partials.highest(day), "last_age": partials.last(age, day)}


def edges(daily: DataFrame, grain: str = "month") -> DataFrame:
    """First and last record of each account and period: day and age as found."""
    keys = ["account", "period"]
    state = partials.fold(daily.withColumn("period", period_of(F.col("dt"), grain)), keys, edge_facts())
    return partials.values(state, keys, edge_facts())


def halo(edge_rows: DataFrame) -> DataFrame:
    """Per account and period the age on the record before it and on the record after it.

    The neighbouring record may be several periods away. One row per account and period is sorted.
    """
    along = Window.partitionBy("account").orderBy("period")
    return edge_rows.select("account", "period", F.lag("last_age").over(along).alias("age_before"),
                            F.lead("first_age").over(along).alias("age_after"))


def repair_in_periods(daily: DataFrame, around: DataFrame, grain: str = "month", tolerance: int = 2,
                      isolated_to_null: bool = False) -> DataFrame:
    """Result of ``dedup.repair_age``, with windows that end at the period.

    ``daily`` holds whole periods, one or many, a row per account and day; ``around`` the
    :func:`halo` of the same periods.
    """
    days = Window.partitionBy("account", "_period").orderBy("dt")
    joined = daily.withColumn("_period", period_of(F.col("dt"), grain)).join(
        around.withColumnRenamed("period", "_period"), ["account", "_period"])
    before = F.when(F.lag("dt").over(days).isNull(), F.col("age_before")).otherwise(F.lag("age").over(days))
    after = F.when(F.lead("dt").over(days).isNull(), F.col("age_after")).otherwise(F.lead("age").over(days))
    neighbours = joined.withColumns({"prev_age": before, "next_age": after}).drop("age_before", "age_after")
    return fixed_age(neighbours, tolerance, isolated_to_null).drop("_period")
