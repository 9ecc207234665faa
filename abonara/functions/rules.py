"""First-match rule chains and pattern predicates built from data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Label of the first rule whose predicate is true (null predicates do not match)."""
    chain = F
    for predicate, label in rules:
        chain = chain.when(predicate, label if isinstance(label, Column) else F.lit(label))
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def _in_order(parts: Sequence[str]) -> str:
    """Regular expression that finds each part after the one before it.

    The atomic groups take the leftmost hit of each part and never give it back, which is
    all that ``%p1%p2%`` needs and keeps the scan linear; the pattern that LIKE itself
    builds backtracks and is quadratic on long texts that repeat the first part.
    """
    return "".join(rf"(?>.*?\Q{part}\E)" for part in parts)


def like_any(text: Column, patterns: Sequence[str]) -> Column:
    """OR of LIKE patterns that start and end with a percent sign.

    A pattern of several fragments first asks whether the text holds each of them, which
    is a fast byte search and settles nearly all rows; only then the order is checked.
    Give this function a column, not an expression: it refers to ``text`` many times.
    """
    tests = []
    for pattern in patterns:
        if not (pattern.startswith("%") and pattern.endswith("%")) or "_" in pattern:
            raise ValueError(f"not a %...% pattern: {pattern!r}")
        parts = [part for part in pattern.split("%") if part]
        test = all_of(text.contains(part) for part in dict.fromkeys(parts))
        if len(parts) > 1:
            test = test & text.rlike("(?s)^" + _in_order(parts))
        tests.append(test)
    return any_of(tests)
