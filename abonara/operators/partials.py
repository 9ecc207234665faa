"""First, last, lowest and highest as mergeable state.

Each fact is kept as the smallest or largest (order, value) seen so far. Taking the smaller of two
is associative, commutative and harmless to repeat, so the state of a period can be built from new
days alone, merged with what late rows bring, and rolled up from account-periods to accounts, always
with the result of one pass over all rows. Ties of the order are broken by the value.

Facts that need their neighbours, such as the repaired age, are not mergeable; see ``repair``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from abonara.sources.commits import PeriodStore


class Fact(NamedTuple):
    """How a fact is found in a row, and whether the smallest or the largest one is kept."""

    entry: Column
    smallest: bool


def _entry(value: Column, order: Column, known: bool) -> Column:
    usable = order.isNotNull() & value.isNotNull() if known else order.isNotNull()
    return F.when(usable, F.struct(order.alias("by"), value.alias("value")))


def first(value: Column, order: Column, known: bool = False) -> Fact:
    """The value of the first row by ``order``; with ``known`` of the first row that has one."""
    return Fact(_entry(value, order, known), True)


def last(value: Column, order: Column, known: bool = False) -> Fact:
    return Fact(_entry(value, order, known), False)


def lowest(value: Column) -> Fact:
    return first(value, value)


def highest(value: Column) -> Fact:
    return last(value, value)


def _aggregates(facts: Mapping[str, Fact], source) -> list[Column]:
    return [(F.min if fact.smallest else F.max)(source(name, fact)).alias(name) for name, fact in facts.items()]


def fold(rows: DataFrame, keys: Sequence[str | Column], facts: Mapping[str, Fact]) -> DataFrame:
    """State of ``rows``: one row per key, a struct (by, value) per fact."""
    return rows.groupBy(*keys).agg(*_aggregates(facts, lambda name, fact: fact.entry))


def merge(states: Iterable[DataFrame], keys: Sequence[str | Column], facts: Mapping[str, Fact]) -> DataFrame:
    """One state from several, or a roll-up of one state to fewer ``keys``."""
    stacked = reduce(lambda a, b: a.unionByName(b), states)
    return stacked.groupBy(*keys).agg(*_aggregates(facts, lambda name, fact: F.col(name)))


def values(state: DataFrame, keys: Sequence[str], facts: Mapping[str, Fact]) -> DataFrame:
    """The facts themselves."""
    return state.select(*keys, *[F.col(f"{name}.value").alias(name) for name in facts])


def save_late(store: PeriodStore, name: str, late: DataFrame, keys: Sequence[str], facts: Mapping[str, Fact]) -> None:
    """Merge the state of late rows into the saved periods that they touch, and only into these.

    ``late`` is a state by ``period`` and the other keys; a period that was never saved is added.
    The periods, not the rows, pass the driver.
    """
    touched = {r.period for r in late.select("period").distinct().collect()}
    known = touched & set(store.periods(name))
    states = [late] + ([store.read(name, only=known).select(*late.columns)] if known else [])
    store.save_all(name, merge(states, keys, facts))
