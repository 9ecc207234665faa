"""Registry of queries: a Spark callable and, beside it, the SQL that checks it.

The SQL is written by hand against the raw tables. Shared derivations are named
fragments; a statement lists the ones it needs and gets them in dependency order.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from abonara.plans.fixtures import Inputs
from abonara.session import tune


class Case(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: tuple[str, ...]


CASES: dict[str, Case] = {}
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def fragment(name: str, needs: str, body: str) -> None:
    FRAGMENTS[name] = (tuple(needs.split()), body.strip())


def with_fragments(needs: str, select: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in FRAGMENTS[name][0]:
                add(need)
            ordered.append(name)

    for name in needs.split():
        add(name)
    ctes = [f"{n} AS ({FRAGMENTS[n][1]})" for n in ordered]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select.strip()


def as_of(name: str, source: str, condition: str, suffix: str) -> str:
    """Clone fragment ``name`` and all it needs on only those rows of ``source`` that meet ``condition``.

    Returns the name of the clone; clones have the names of the originals plus ``suffix``.
    """
    needed: list[str] = []

    def add(n: str) -> bool:
        """Does ``n`` rest on the source? Only such fragments are cloned."""
        rests = n == source or any([add(d) for d in FRAGMENTS[n][0]])
        if rests and n not in needed:
            needed.append(n)
        return rests

    add(name)
    rename = lambda text: re.sub(rf"\b({'|'.join(needed)})\b", rf"\1{suffix}", text)
    for n in needed:
        needs, body = FRAGMENTS[n]
        if n == source:
            FRAGMENTS[n + suffix] = (needs, f"SELECT * FROM ({body}) WHERE {condition}")
        else:
            FRAGMENTS[n + suffix] = (tuple(d + suffix if d in needed else d for d in needs), rename(body))
    return name + suffix


def case(name: str, ids: str, needs: str = "", sql: str | None = None):
    """Register ``fn(inputs)`` under ``name``; ``ids`` are the inventory rows it covers."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in CASES:
            raise ValueError(f"duplicate query {name}")
        run = lambda spark, folder: fn(Inputs(tune(spark), folder))
        CASES[name] = Case(run, with_fragments(needs, sql) if sql else None, tuple(ids.split()))
        return fn

    return register
