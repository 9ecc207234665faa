"""Exact distinct counts that can be merged: stored bitmaps of account numbers.

``count(distinct account)`` of a month cannot be had from the counts of its weeks. Here every
account gets a whole number once; per period and dimensions, and for each flag, the numbers of the
accounts are kept as bitmaps of 32,768 neighbours each. Counts of any period range and any subset of
the dimensions are unions of stored bitmaps: no account row is read again, and the result is the
exact count. Numbers of accounts that came together lie together, so bitmaps are well filled.

A group is spread over as many rows as there are buckets, and bitmaps are united before the
shuffle, so a dimension value that holds most accounts is no hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from abonara.session import written
from abonara.sources.commits import PeriodStore


def number_accounts(store: PeriodStore, name: str, accounts: DataFrame, period: date) -> DataFrame:
    """Give numbers to accounts that have none, save them, and return all numbers.

    Saved numbers never change: new ones are saved beside them, under ``period`` or the first day
    after it that is free. A repeated run finds no new accounts and saves nothing.
    """
    wanted = accounts.select("account").where(F.col("account").isNotNull()).distinct()
    taken = set(store.periods(name))
    if taken:
        known = store.read(name).drop("period")
        new, start = wanted.join(known, "account", "left_anti"), known.agg(F.max("number")).first()[0]
        first = 0 if start is None else start + 1
    else:
        known, new, first = None, wanted, 0
    # Numbers run through inside a task; every task has a range of its own.
    numbered = new.select("account", (F.monotonically_increasing_id() + F.lit(first)).alias("number"))
    if known is None or not new.isEmpty():
        free = period
        while free in taken:
            free += timedelta(days=1)
        store.save(name, free, numbered)
    return store.read(name).drop("period")


def bitmaps(rows: DataFrame, numbers: DataFrame, dims: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """One bitmap per dimensions, bucket of numbers and flag; ``flags`` are true for rows that count."""
    numbered = rows.join(numbers, "account").withColumn("bucket", F.bitmap_bucket_number("number"))
    bit = F.bitmap_bit_position("number")
    return numbered.groupBy(*dims, "bucket").agg(
        *[F.bitmap_construct_agg(F.when(keep, bit)).alias(n) for n, keep in flags.items()])


def unite(stored: DataFrame, by: Sequence[str | Column], flags: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer dimensions or longer periods from stored ones."""
    return stored.groupBy(*by, "bucket").agg(*[F.bitmap_or_agg(n).alias(n) for n in flags])


def counts(stored: DataFrame, by: Mapping[str, Column], flags: Sequence[str]) -> DataFrame:
    """Distinct accounts per flag and group; ``by`` names the grouping columns."""
    united = unite(stored, [c.alias(n) for n, c in by.items()], flags)
    return united.groupBy(*by).agg(*[F.sum(F.bitmap_count(n)).cast("long").alias(n) for n in flags])


class DistinctCube:
    """Saved bitmaps of one cube: account numbers and, per period, the bitmaps of its dimensions."""

    def __init__(self, store: PeriodStore, name: str, dims: Sequence[str], flags: Mapping[str, Column]):
        self.store, self.name, self.dims, self.flags = store, name, list(dims), dict(flags)

    def add(self, rows: DataFrame) -> list[date]:
        """Save the bitmaps of every ``period`` in ``rows``; periods saved before are replaced.

        Numbering and counting both read the rows, so they are written once, reduced to what counts.
        """
        marks = {n: F.col(f"_in_{n}") for n in self.flags}
        rows = written(rows.select("account", "period", *self.dims, *[
            F.coalesce(keep, F.lit(False)).alias(f"_in_{n}") for n, keep in self.flags.items()]), f"{self.name}_rows")
        first = rows.agg(F.min("period")).first()[0]
        if first is None:
            return []
        numbers = number_accounts(self.store, f"{self.name}_accounts", rows, first)
        return self.store.save_all(self.name, bitmaps(rows, numbers, ["period", *self.dims], marks))

    def counts(self, by: Mapping[str, Column], first: date | None = None, last: date | None = None) -> DataFrame:
        """Distinct accounts by any columns made of ``period`` and the dimensions."""
        return counts(self.store.read(self.name, first, last), by, list(self.flags))
