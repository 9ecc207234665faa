"""Parquet sources and the month-partitioned result sink."""

from __future__ import annotations

import time
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import period_of


#: Schemas of the supplied tables; an explicit schema saves the footer scan that finds one.
SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def active_base(
    snap: DataFrame,
    types: Iterable[str] | None = V.RESIDENTIAL_TYPES,
    states: Iterable[str] | None = V.LIVE_STATES,
    excluded_types: Iterable[str] | None = None,
    type_col: str = "cust_type",
    state_col: str = "state",
) -> DataFrame:
    """Keep wanted customer types and account states; pure predicates, so they push down.

    Markets differ: some name the wanted types, some only exclude business customers.
    """
    if types is not None:
        snap = snap.where(F.col(type_col).isin(*types))
    if excluded_types is not None:
        snap = snap.where(~F.col(type_col).isin(*excluded_types))
    if states is not None:
        snap = snap.where(F.col(state_col).isin(*states))
    return snap


def union_orders(current: DataFrame, deprecated: DataFrame) -> DataFrame:
    """Current and deprecated order tables as one; columns only one side has become null."""
    return current.unionByName(deprecated, allowMissingColumns=True)


def prepaid_base(prepaid: DataFrame, day: Column) -> DataFrame:
    """Open, active, individual prepaid subscribers on one day, once each."""
    return (
        prepaid.where(
            (F.col("dt") == day)
            & (F.col("cust_state") == "O")
            & (F.col("account_type") == "I")
            & (F.col("region") != "VI")
            & (F.col("subscription_state") == "A")
        )
        .select(F.col("subscription_id").alias("phone"))
        .distinct()
    )


def clean_interactions(
    raw: DataFrame, first_month: Column, months: int = 2, start: str = "start_text"
) -> DataFrame:
    """Drop blank start times, read the first ten characters as the day, keep a window.

    The window is the month of ``first_month`` and the ``months`` after it.
    """
    text = F.col(start).cast("string")
    day = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    return (
        raw.where(text.isNotNull() & (F.trim(text) != ""))
        .withColumn("day", day)
        .withColumn("period", period_of(F.col("day"), "month"))
        .where(F.col("period").between(first_month, F.add_months(first_month, months)))
    )


_MONTH_LOG = "month STRING, state STRING, at LONG"


def _note(spark: SparkSession, path: str, *rows: tuple) -> None:
    spark.createDataFrame(list(rows), _MONTH_LOG).coalesce(1).write.mode("append").parquet(f"{path}/_months")


def _is_complete(spark: SparkSession, path: str, month: str) -> bool:
    """Was the month's last write finished? A write that was cut off has begun and not finished."""
    _note(spark, path)  # the log must be there to be read
    log = spark.read.schema(_MONTH_LOG).parquet(f"{path}/_months").where(F.col("month") == month)
    return log.agg(F.max_by("state", "at")).first()[0] == "finished"


def save_month(df: DataFrame, path: str, month: str, replace: bool = False) -> bool:
    """Write one month's rows under its own partition folder; tells whether it wrote.

    Without ``replace`` a finished month is left alone and its result is not computed
    again; a month that a lost job left half-written is written anew. Months that other
    tables are built from belong in :class:`abonara.sources.commits.PeriodStore`.
    """
    spark = df.sparkSession
    if not replace and _is_complete(spark, path, month):
        return False
    _note(spark, path, (month, "begun", time.time_ns()))
    part = df.where(F.col("period") == F.lit(month).cast("date")).drop("period")
    part.write.mode("overwrite").parquet(f"{path}/period={month}")
    _note(spark, path, (month, "finished", time.time_ns()))
    return True


def save_periods(df: DataFrame, path: str) -> None:
    """Write all periods of ``df``; only the periods it holds are replaced."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("period")
       .parquet(path))


def read_periods(spark: SparkSession, path: str, first: str = None, last: str = None) -> DataFrame:
    """Read saved periods; the bounds prune partitions."""
    df = spark.read.parquet(path).withColumn("period", F.col("period").cast("date"))
    if first is not None:
        df = df.where(F.col("period") >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col("period") <= F.lit(last).cast("date"))
    return df


def stack_months(tables: Iterable[DataFrame]) -> DataFrame:
    """Stack monthly result tables; older layouts may miss columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
