"""Account histories as arrays: one row per account, one slot per period after its first.

The rows of an account are put together once; survival, churn period and type, charges and RGUs are
then expressions over its slots. The joined form in ``cohort`` follows any table of sales; this one
follows accounts from their first period and needs neither a join nor a second scan. An account has
at most one row per period, which bounds the array.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abonara.functions.calendar import period_index, period_of, shift_period


def follow(closing: DataFrame, columns: Sequence[str], live: Column, n: int = 12, grain: str = "month") -> DataFrame:
    """account, sale_period, first (the first row) and slots 0..n, null where there is no live row.

    ``closing`` has one row per account and period. Every account is kept.
    """
    entry = F.struct("period", live.alias("live"), *columns)
    rows = closing.groupBy("account").agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    first = F.get("rows", F.lit(0))
    place = lambda r: period_index(first["period"], r["period"], grain)
    kept = F.filter("rows", lambda r: F.coalesce(r["live"], F.lit(False)) & (place(r) <= n))
    by_place = F.map_from_entries(F.transform(kept, lambda r: F.struct(place(r), r)))
    return rows.select("account", first["period"].alias("sale_period"), first.alias("first"), by_place.alias("_at")).select(
        "account", "sale_period", "first", F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.try_element_at("_at", k)).alias("slots"))


def seen(slots: str = "slots") -> Column:
    """Does any slot hold a row?"""
    return F.exists(slots, lambda s: s.isNotNull())


def survival(followed: DataFrame, grain: str = "month", max_age: int = 90, gap_periods: Sequence[str] = ()) -> DataFrame:
    """Add arrays ``surv`` (1 or null), ``age`` and the value ``max_unpaid_dt``; unseen accounts are left out.

    The rules are those of ``cohort.survival_panel``: alive below ``max_age``, and everybody alive in
    ``gap_periods``, when the source had no data.
    """
    gaps = [F.to_date(F.lit(g)) for g in gap_periods]
    gap = (lambda k: shift_period(F.col("sale_period"), k, grain).isin(*gaps)) if gaps else (lambda k: F.lit(False))
    alive = lambda s: s.isNotNull() & (s["age"].isNull() | (s["age"] < max_age))
    return followed.where(seen()).withColumns({
        "surv": F.transform("slots", lambda s, k: F.when(alive(s) | gap(k), 1)),
        "age": F.transform("slots", lambda s: s["age"]),
        "max_unpaid_dt": F.array_max(F.transform("slots", lambda s: s["unpaid_dt"]))})


def losses(panel: DataFrame, as_of: Column, grain: str = "month", days: int = 90) -> DataFrame:
    """Add arrays ``churn`` (1 where alive before and gone, in periods over on ``as_of``) and ``churn_type``."""
    over = lambda k: shift_period(F.col("sale_period"), k, grain) < period_of(as_of, grain)
    before = lambda k: F.get("surv", k - 1)
    churn = F.transform("surv", lambda s, k: F.when(s.isNull() & ((k == 0) | ((before(k) == 1) & over(k))), 1))
    kind = F.transform("churn", lambda c, k: F.when(c == 1, F.when(
        F.get("age", k) >= days, "Involuntary").otherwise("Voluntary")))
    return panel.withColumn("churn", churn).withColumn("churn_type", kind)


def wide(panel: DataFrame, keep: Sequence[str], arrays: Mapping[str, Column | str], n: int = 12) -> DataFrame:
    """Arrays as columns ``{name}_0`` to ``{name}_n``."""
    at: Callable = lambda c, k: F.get(F.col(c) if isinstance(c, str) else c, F.lit(k))
    return panel.select(*keep, *[at(c, k).alias(f"{name}_{k}") for name, c in arrays.items() for k in range(n + 1)])
