"""Opening and closing snapshots, their pairing, and account movements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import boundary_day, complete_months, period_of, shift_period
from abonara.functions.profile import flag
from abonara.functions.rules import first_match
from abonara.operators.dedup import keep_one


def _old_enough(age: Column, max_age: int | None, inclusive: bool, unpaid_days: Column | None) -> Column:
    if max_age is None:
        return F.lit(True)
    below = (lambda c: c <= max_age) if inclusive else (lambda c: c < max_age)
    kept = below(age) | age.isNull()
    return kept if unpaid_days is None else kept | below(unpaid_days)


def closing_rows(daily: DataFrame, grain: str = "month", order: Sequence[Column] = ()) -> DataFrame:
    """Last row of each account and period, with the ``period`` it closes."""
    order = list(order) or [F.desc("dt")]
    return keep_one(daily.withColumn("period", period_of(F.col("dt"), grain)),
                    ["account", "period"], order)


def held_lines() -> Column:
    """Aggregate: product lines that had a name on any day."""
    held = lambda c: flag(F.count(c) > 0)
    return held("vo_nm") + held("bb_nm") + held("tv_nm")


def named_lines() -> Column:
    """Product lines that have a name."""
    named = lambda c: flag(F.col(c).isNotNull())
    return named("vo_nm") + named("bb_nm") + named("tv_nm")


def account_closing(daily: DataFrame, grain: str = "month") -> DataFrame:
    """Last row of each account and period, with what the account tables ask about the account.

    ``daily`` has one row per account and day with product names, ``inst_dt`` and ``age_fix`` (see
    ``dedup.repair_age``). Adds ``held_rgus`` (lines held at any time in the period), ``start_dt``,
    ``max_inst_dt``, ``first_rgus`` of the account and ``tenure``.

    Everything is read along the days of an account, in the order that the repair has made: the
    last row of a period is the one whose successor lies in another, and what a period held is the
    difference of running counts between two such rows. So no further shuffle or sort is needed.
    """
    along, whole = Window.partitionBy("account").orderBy("dt"), Window.partitionBy("account")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    lines = {f"_{c}": c for c in ("vo_nm", "bb_nm", "tv_nm")}
    rows = daily.drop("prev_age", "next_age", "is_jump").withColumns({
        "period": period_of(F.col("dt"), grain), "_next": F.lead("dt").over(along),
        **{n: F.count(c).over(upto) for n, c in lines.items()},
        "first_rgus": F.first(named_lines()).over(upto), "start_dt": F.first("dt").over(upto),
        "max_inst_dt": F.max("inst_dt").over(whole)})
    last = rows.where(F.col("_next").isNull() | (period_of(F.col("_next"), grain) != F.col("period")))
    held = sum(flag(F.col(n) > F.coalesce(F.lag(n).over(along), F.lit(0))) for n in lines)
    return last.withColumns({"held_rgus": held, "tenure": complete_months(F.col("start_dt"), F.col("dt"))}).drop("_next", *lines)


def _side(daily, prefix, columns, grain, boundary, shift, kept):
    day = F.col("dt")
    rows = daily if boundary is None else daily.where(boundary_day(day, boundary, grain))
    period = F.col("period") if boundary is None else period_of(day, grain)
    return rows.where(kept).select(
        shift_period(period, shift, grain).alias("period"), "account",
        F.col("dt").alias(f"{prefix}date"),
        *[F.col(c).alias(f"{prefix}{c}") for c in columns])


def bom_snapshot(daily: DataFrame, columns: Sequence[str], grain: str = "month",
                 max_age: int = 90, boundary: str | None = "last", age: str = "age",
                 unpaid: str | None = None) -> DataFrame:
    """Opening base of each period: boundary-day rows with an age below ``max_age``.

    With the ``last`` day as boundary a row opens the next period, with the ``second``
    day its own. ``boundary=None`` takes rows already reduced by :func:`closing_rows`.
    ``unpaid`` names the oldest-unpaid date that may overrule a stuck age.
    """
    unpaid_days = None if unpaid is None else F.datediff("dt", F.col(unpaid))
    kept = _old_enough(F.col(age), max_age, False, unpaid_days)
    return _side(daily, "b_", columns, grain, boundary, 0 if boundary == "second" else 1, kept)


def eom_snapshot(daily: DataFrame, columns: Sequence[str], grain: str = "month",
                 max_age: int = 90, boundary: str | None = "last", age: str = "age",
                 unpaid: str | None = None) -> DataFrame:
    """Closing base of each period: the same rows one period earlier, age up to ``max_age``."""
    unpaid_days = None if unpaid is None else F.datediff("dt", F.col(unpaid))
    kept = _old_enough(F.col(age), max_age, True, unpaid_days)
    return _side(daily, "e_", columns, grain, boundary, -1 if boundary == "second" else 0, kept)


def pair_snapshots(bom: DataFrame, eom: DataFrame, keys: Sequence[str] = ("period", "account")):
    """One row per account and period with both sides and their active flags."""
    return (
        bom.withColumn("_b", F.lit(1)).join(eom.withColumn("_e", F.lit(1)), list(keys), "full")
        .withColumn("active_bom", F.coalesce("_b", F.lit(0)))
        .withColumn("active_eom", F.coalesce("_e", F.lit(0)))
        .drop("_b", "_e")
    )


def pair_closing_rows(closing: DataFrame, columns: Sequence[str], grain: str = "month",
                      max_age: int | None = 90, age: str = "age", unpaid: str | None = None,
                      earlier: Sequence[str] = ()) -> DataFrame:
    """Same result as opening, closing and pairing, from one pass over ``closing``.

    ``closing`` has at most one row per account and period, with the day ``dt`` of that period.
    ``max_age=None`` keeps rows of every age. ``earlier`` names columns that are also taken, as
    ``p_{column}``, from the closing row before the opening one, if it is of the period before.

    Each closing row plays two roles, end of its period and start of the next. Its opening row is
    the one before it in the account; when the next period has no row, it opens that period alone.
    So everything is read along the days of an account: rows that come in this order, as those of
    :func:`account_closing`, are neither moved nor sorted again, which would take the memory of
    both sides of all rows of a task.
    """
    unpaid_days = None if unpaid is None else F.datediff("dt", F.col(unpaid))
    opens = F.coalesce(_old_enough(F.col(age), max_age, False, unpaid_days), F.lit(False))
    closes = F.coalesce(_old_enough(F.col(age), max_age, True, unpaid_days), F.lit(False))
    along, period = Window.partitionBy("account").orderBy("dt"), F.col("period")
    state = F.struct(F.col("dt").alias("date"), *[F.col(c) for c in columns])
    rows = closing.select(
        "account", "dt", "period", state.alias("state"), opens.alias("opens"), closes.alias("closes"),
        *[F.col(c).alias(f"_{c}") for c in earlier])
    past = lambda n, *cells: F.lag(F.struct(period.alias("period"), *cells), n).over(along)
    cells = [F.col(f"_{c}") for c in earlier]
    rows = rows.withColumns(
        {"_one": past(1, F.when(F.col("opens"), F.col("state")).alias("state"), *cells), "_next": F.lead("period").over(along)}
        | ({"_two": past(2, *cells)} if earlier else {}))
    is_before = lambda row, n: F.coalesce(shift_period(F.col(f"{row}.period"), n, grain) == period, F.lit(False))
    following = shift_period(period, 1, grain)
    # Rows without a period have one all the same: such a row is both sides of it.
    undated = period.isNull()
    opening = F.when(undated, F.when(F.col("opens"), F.col("state"))).when(is_before("_one", 1), F.col("_one.state"))
    followed = undated | F.coalesce(F.col("_next") == following, F.lit(False))
    roles = F.filter(F.array(F.when(F.col("closes") | opening.isNotNull(), F.lit("own")),
                             F.when(F.col("opens") & ~followed, F.lit("after"))), lambda r: r.isNotNull())
    rows = rows.select("*", F.explode(roles).alias("role"))
    own = F.col("role") == "own"
    before = lambda c: (
        F.when(own, F.when(is_before("_one", 1) & (shift_period(F.col("_two.period"), 1, grain) == F.col("_one.period")), F.col(f"_two._{c}"))
               .when(is_before("_one", 2), F.col(f"_one._{c}"))).when(is_before("_one", 1), F.col(f"_one._{c}")))
    sides = rows.select(
        F.when(own, period).otherwise(following).alias("period"), "account",
        F.when(own, opening).otherwise(F.col("state")).alias("b"),
        F.when(own & F.col("closes"), F.col("state")).alias("e"), *[before(c).alias(f"p_{c}") for c in earlier])
    return sides.select(
        "period", "account",
        F.when(F.col("b").isNotNull(), 1).otherwise(0).alias("active_bom"),
        F.when(F.col("e").isNotNull(), 1).otherwise(0).alias("active_eom"),
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "be" for c in ("date", *columns)],
        *[f"p_{c}" for c in earlier])


def main_movement(pair: DataFrame, rule: str = "recent_install", migrated: Column | None = None):
    """Add ``main_movement`` and ``rgu_change``.

    ``recent_install`` asks returning accounts for an installation at most one month old
    and gives later ones their own label; ``start_month`` looks only at the start month.
    ``migrated`` marks lost accounts that became business accounts.
    """
    change = F.col("e_num_rgus") - F.col("b_num_rgus")
    period, start = F.col("period"), F.col("e_start_dt")
    arrives = F.col("b_num_rgus").isNull() & (F.col("e_num_rgus") > 0)
    started_elsewhen = F.trunc(start, "month") != period
    lost = (F.col("active_bom") == 1) & (F.col("active_eom") == 0)
    size_rules = [(change == 0, V.SAME), (change > 0, V.UPSELL), (change < 0, V.DOWNSELL)]
    if rule == "recent_install":
        installed_lately = complete_months(F.col("e_max_inst_dt"), period) <= 1
        rules = size_rules + [
            (arrives & started_elsewhen & installed_lately, V.COME_BACK),
            (arrives & (complete_months(start, period) <= 1), V.NEW),
            (lost, V.LOSS),
            (arrives & started_elsewhen, V.MISSING),
        ]
    elif rule == "start_month":
        rules = size_rules + [(arrives & started_elsewhen, V.COME_BACK), (arrives, V.NEW)]
        if migrated is not None:
            rules.append((lost & migrated, V.TO_BUSINESS))
        rules.append((lost, V.LOSS))
    else:
        raise ValueError("rule must be 'recent_install' or 'start_month'")
    return pair.withColumns({"main_movement": first_match(rules), "rgu_change": change})


def spin(before: Column, after: Column, movement: Column) -> Column:
    """Did the charge move while the RGUs stayed?

    One script compares with a label that its own movement step never produces; the rule
    here is the intended one.
    """
    same = movement == V.SAME
    return first_match([
        (same & (after > before), "1. Up-spin"),
        (same & (after < before), "2. Down-spin"),
    ], "3. No Spin")


def mobile_movement(pair: DataFrame) -> DataFrame:
    """Add ``fmc_account`` and ``mobile_movement`` to a mobile pair."""
    before, after = F.col("b_mrc"), F.col("e_mrc")
    both = (F.col("active_bom") == 1) & (F.col("active_eom") == 1)
    contract = lambda c: F.when(~F.col(c).isin(*V.MISSING_CONTRACT), F.col(c))
    return pair.withColumns({
        "fmc_account": F.coalesce(
            contract("b_fixed_contract"), contract("e_fixed_contract"), "mobile_account"),
        "mobile_movement": first_match([
            (both & (before == after), "01.Maintain"),
            (both & (before > after), "02.Downspin"),
            (both & (before < after), "03.Upspin"),
            ((F.col("active_bom") == 1) & (F.col("active_eom") == 0), "04.Loss"),
            (before.isNull() | after.isNull(), "07.MRC Gap"),
        ]),
    })


def segment_migration(before: DataFrame, after: DataFrame, keys: Sequence[str],
                      kind: str = "kind", business: str = "B2B") -> DataFrame:
    """Keys that were not business customers before and are after, once each."""
    was = before.where(F.col(kind) != business).select(*keys).distinct()
    now = after.where(F.col(kind) == business).select(*keys).distinct()
    return was.join(now, list(keys), "left_semi")


def movement_summary(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Accounts and RGUs before and after per combination of dimensions."""
    return df.groupBy(*dims).agg(
        F.count_distinct("account").alias("accounts"),
        F.sum("b_num_rgus").alias("b_rgus"),
        F.sum("e_num_rgus").alias("e_rgus"))
