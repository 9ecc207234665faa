"""Contact and experience drivers.

Contacts are first reduced to one row per account and day (or period). A look-back then
is a range window over days of one account, bounded by the calendar, where the scripts
join every contact with every other contact of the account.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import period_of, shift_period
from abonara.functions.profile import classify_technical, flag
from abonara.functions.rules import first_match

KEYS = ["account", "period"]


def early_contact(sales: DataFrame, contacts: DataFrame, days: int = 21, grain: str = "month",
                  lower: int | None = 0) -> DataFrame:
    """Sold accounts with a contact at most ``days`` days after the sale.

    ``sales`` has one row per account with ``sale_day``. The scripts set no lower bound,
    so contacts before the sale count there as well: pass ``lower=None`` for that.
    """
    per_day = contacts.groupBy("account", "day").agg(F.count("*").alias("n"))
    after = F.datediff("day", "sale_day")
    hit = after <= days if lower is None else after.between(lower, days)
    return (per_day.join(sales.select("account", "sale_day"), "account").where(hit)
            .groupBy("account", period_of(F.col("sale_day"), grain).alias("period"))
            .agg(F.sum("n").alias("contacts"), F.min("day").alias("first_contact")))


def early_ticket(sales: DataFrame, tickets: DataFrame, weeks: int = 7, grain: str = "month") -> DataFrame:
    """Sold accounts with a technical ticket within ``weeks`` complete weeks of the sale."""
    return early_contact(sales, tickets, 7 * weeks + 6, grain)


def contact_counts(contacts: DataFrame, measures: dict[str, Column], grain: str = "month") -> DataFrame:
    """Distinct contacts per account and period for each predicate, in one pass.

    Rows must be deduplicated on the contact id, so a conditional count is a distinct
    count; accounts without any hit are left out.
    """
    counts = contacts.groupBy("account", period_of(F.col("day"), grain).alias("period")).agg(
        *[F.count(F.when(test, 1)).alias(name) for name, test in measures.items()])
    return counts.where(" OR ".join(f"{name} > 0" for name in measures))


def not_annulled() -> Column:
    return F.col("status") != "ANULADA"


def bill_claims(contacts: DataFrame, purposes: Iterable[str] = V.BILLING_PURPOSES,
                grain: str = "month") -> DataFrame:
    """Billing contacts per account and period."""
    return contact_counts(contacts, {"claims": F.col("purpose").isin(*purposes) & not_annulled()}, grain)


def failed_visits(contacts: DataFrame, grain: str = "month") -> DataFrame:
    """Account-periods with a cancelled or annulled visit."""
    return contact_counts(contacts, {"failed": F.col("status").isin(*V.CANCELLED_STATES)}, grain)


def ticket_density(contacts: DataFrame, purposes: Iterable[str] = V.TECHNICAL_PURPOSES,
                   grain: str = "month") -> DataFrame:
    """Technical contacts per account and period, whatever their state."""
    return contact_counts(contacts, {"tickets": F.col("purpose").isin(*purposes)}, grain)


def bill_shock(df: DataFrame, pct: float = 0.05) -> DataFrame:
    """Charge moved more than ``pct`` of the opening charge while the plans stayed.

    Adds ``no_plan_change`` and ``bill_shock`` (account ids or null).
    """
    same_plan = F.when(F.col("b_plan_full") == F.col("e_plan_full"), F.col("fixed_account"))
    moved = F.abs("mrc_change") > F.col("b_total_mrc") * pct
    shock = F.when(moved & (F.col("b_plan") == F.col("e_plan")) & same_plan.isNotNull(), F.col("fixed_account"))
    return df.withColumns({"no_plan_change": same_plan, "bill_shock": shock})


def mrc_increase(table: DataFrame, ratio: float = 1.05, max_age: int = 85, grain: str = "month") -> DataFrame:
    """Closing charge against the opening charge of the period before, both not overdue.

    One ordered look back per account; it has one row per period there.
    """
    window = Window.partitionBy("account").orderBy("period")
    before = F.lag(F.struct("period", "b_bill_amt", "b_age")).over(window)
    rows = table.withColumn("_p", before).where(
        (shift_period(F.col("_p.period"), 1, grain) == F.col("period"))
        & (F.col("_p.b_age") < max_age) & (F.col("e_age") < max_age))
    grown = F.try_divide(F.col("e_bill_amt"), F.col("_p.b_bill_amt"))
    return rows.select("period", "account",
                       F.when(grown > ratio, F.col("account")).alias("mrc_increase"),
                       F.when(grown <= ratio, F.col("account")).alias("no_plan_change"))


def relative_mrc_change(daily: DataFrame, charge: str = "bill_amt", pct: float = 0.05) -> DataFrame:
    """Relative charge change between neighbouring rows that hold the same three products."""
    window = Window.partitionBy("account").orderBy("dt")
    names = ["vo_nm", "bb_nm", "tv_nm"]
    rows = daily.withColumn("_p", F.lag(F.struct(charge, *names)).over(window))
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"_p.{n}"))
    change = F.try_divide(F.col(charge) - F.col(f"_p.{charge}"), F.col(f"_p.{charge}"))
    return rows.where(same).select("account", "dt", change.alias("change"),
                                   F.when(F.abs(change) > pct, F.col("account")).alias("mrc_change_flag"))


def long_install(orders: DataFrame, days: int = 5, grain: str = "month") -> DataFrame:
    """Account-periods (of completion) with an installation that took more than ``days``."""
    took = F.datediff("completed", "start")
    slow = orders.where((F.col("order_type") == V.INSTALL) & (F.col("status") == V.FINISHED) & (took > days))
    return slow.groupBy("account", period_of(F.col("completed"), grain).alias("period")).agg(
        F.max(took).alias("days_taken"))


def mounting_bill(ages: DataFrame, day: int = 60, grain: str = "month", age: str = "age_fix") -> DataFrame:
    """Did the age hit exactly ``day`` in the period?"""
    return ages.groupBy("account", period_of(F.col("dt"), grain).alias("period")).agg(
        F.max(flag(F.col(age) == day)).alias("mounting_bill"))


def mounting_bill_pair(closing: DataFrame, grain: str = "month") -> DataFrame:
    """Older rule: the oldest unpaid bill is the same as one period earlier."""
    window = Window.partitionBy("account").orderBy("period")
    before = F.lag(F.struct("period", "unpaid_dt")).over(window)
    same = ((shift_period(F.col("_p.period"), 1, grain) == F.col("period"))
            & (F.col("_p.unpaid_dt") == F.col("unpaid_dt"))
            & F.col("age").isNotNull() & F.col("bill_dt").isNotNull())
    return closing.withColumn("_p", before).select("account", "period", flag(same).alias("mounting_bill"))


def _look_back(daily: DataFrame, days: int) -> Column:
    """Contacts of the account in the ``days`` days up to each day."""
    number = F.unix_date("day")
    window = Window.partitionBy("account").orderBy(number).rangeBetween(-days, 0)
    return F.sum("n").over(window)


def _tier(count: Column, names: Sequence[str], account: Column) -> dict[str, Column]:
    tests = [count == 1, count == 2, count >= 3]
    return {name: F.when(test, account) for name, test in zip(names, tests)}


def repeat_callers(contacts: DataFrame, days: int = 60, excluded: Iterable[str] = V.EXCLUDED_PURPOSES,
                   grain: str = "month") -> DataFrame:
    """Contacts in the ``days`` before an account's last counting contact of the period.

    The last contact must not be annulled nor have an excluded purpose; the look-back
    counts every contact. Contacts are deduplicated beforehand.
    """
    counting = not_annulled() & ~F.col("purpose").isin(*excluded)
    daily = contacts.groupBy("account", "day").agg(
        F.count("*").alias("n"), F.max(flag(counting)).alias("counting"))
    looked = daily.withColumn("contacts", _look_back(daily, days)).where("counting = 1")
    last = looked.groupBy("account", period_of(F.col("day"), grain).alias("period")).agg(
        F.max("day").alias("last_day"), F.max_by("contacts", "day").alias("contacts"))
    return last.withColumns(_tier(F.col("contacts"), ("one_call", "two_calls", "more_calls"), F.col("account")))


def ticket_tiers(tickets: DataFrame, days: int = 60, grain: str = "month") -> DataFrame:
    """Tickets in the ``days`` up to and including the day of the period's last ticket.

    The script compares time stamps with a bare date and so drops the last day itself;
    the day is meant to count.
    """
    daily = tickets.groupBy("account", "day").agg(F.count("*").alias("n"))
    looked = daily.withColumn("tickets", _look_back(daily, days))
    last = looked.groupBy("account", period_of(F.col("day"), grain).alias("period")).agg(
        F.max_by("tickets", "day").alias("tickets"))
    return last.withColumn("tier", first_match(
        [(F.col("tickets") == 1, "1"), (F.col("tickets") == 2, "2"), (F.col("tickets") >= 3, "3+")]))


def truckroll_match(contacts: DataFrame, truckrolls: DataFrame) -> DataFrame:
    """Full match of contacts and truck rolls by account and day, typed.

    The script filters on the contact purpose after the join and so loses unmatched truck
    rolls; here the caller filters the contacts. Truck rolls are reduced to one row per
    account and day (first job and number of jobs) so that no day multiplies. A left join and
    the jobs without a contact stand for the full join, whose hot keys could not be split.
    """
    jobs = truckrolls.groupBy("account", "day").agg(F.min("job").alias("job"), F.count("*").alias("jobs"))
    lowered = contacts.withColumn("purpose_text", F.lower("purpose_text"))
    alone = jobs.join(lowered.select("account", "day").distinct(), ["account", "day"], "left_anti")
    joined = lowered.join(jobs, ["account", "day"], "left").unionByName(alone, allowMissingColumns=True)
    return joined.withColumn("contact_kind", F.when(F.col("job").isNotNull(), "truckroll").otherwise(
        classify_technical(F.col("purpose_text"))))


def attach_flags(base: DataFrame, flags: dict[str | tuple[str, ...], DataFrame]) -> DataFrame:
    """Attach account flags of many operators with a single join.

    Each table in ``flags`` marks account-periods; a table under several names has a column
    ``mark`` with one of them. They are stacked, reduced to one row per account-period, and
    joined once, so flags can neither repeat base rows nor cost a join each, and a table that
    tells several flags is computed once.
    """
    marks, names = None, []
    for name, table in flags.items():
        names += [name] if isinstance(name, str) else name
        one = table.select(*KEYS, (F.lit(name) if isinstance(name, str) else F.col("mark")).alias("_flag"))
        marks = one if marks is None else marks.unionByName(one)
    wide = marks.groupBy(*KEYS).agg(
        *[F.max(F.when(F.col("_flag") == n, F.col("account"))).alias(n) for n in names])
    return base.join(wide, KEYS, "left")


def driver_summary(df: DataFrame, dims: Sequence[str], flags: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Distinct accounts per flag over dimensions.

    One row per dimensions and account first, then plain sums: many distinct counts in
    one aggregate would expand every row once per flag. Correct because a flag column
    holds the account's own id or null.
    """
    per_account = df.groupBy(*dims, "account").agg(
        *[F.max(flag(F.col(f).isNotNull())).alias(f) for f in flags], *[F.sum(s).alias(s) for s in sums])
    return per_account.groupBy(*dims).agg(
        F.count("account").alias("active_base"), *[F.sum(f).alias(f) for f in flags],
        *[F.sum(s).alias(s) for s in sums])


CHURN_LABELS = ("Fixed Churner", "Full Churner", "Customer Gap", "Churn Exception")


def without_churners(df: DataFrame, labels: Sequence[str] = CHURN_LABELS) -> DataFrame:
    """Drop churned rows; a null churn flag drops the row as well, as ``<>`` does."""
    return df.where(~F.col("final_churn_flag").isin(*labels))


def contact_summary(df: DataFrame, dims: Sequence[str], flags: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """:func:`driver_summary` of the accounts that stay."""
    return driver_summary(without_churners(df), dims, flags, sums)


def calls_per_1k(base: DataFrame, calls: DataFrame, names: Sequence[str], rgus: str = "rgus") -> DataFrame:
    """Calls per thousand RGUs and period; ``calls`` has one row per account-period."""
    joined = base.select(*KEYS, rgus).join(calls, KEYS, "left")
    return joined.groupBy("period").agg(
        F.sum(rgus).alias("rgus"), *[F.sum(n).alias(n) for n in names],
        *[F.round(F.try_divide(F.sum(n) * 1000, F.sum(rgus)), 0).alias(f"{n}_per_1k") for n in names])


def calls_per_variation(base: DataFrame, calls: DataFrame, marked: str = "bill_shock") -> DataFrame:
    """Billing calls of accounts with a bill variation, per such account and period."""
    varied = base.where(F.col(marked).isNotNull()).select(*KEYS).distinct()
    joined = varied.join(calls, KEYS, "left")
    return joined.groupBy("period").agg(
        F.count("*").alias("variations"), F.sum("claims").alias("billing_calls"),
        F.round(F.try_divide(F.sum("claims"), F.count("*")), 3).alias("calls_per_variation"))


def ftr_billing(calls: DataFrame, days: int = 14, grain: str = "month") -> DataFrame:
    """Billing calls without an earlier one within ``days`` days: count and share.

    Only the first call of a day can be such a call, and only if the previous day with a
    call is more than ``days`` back. So the calls are reduced to days and one look back
    per account decides; no call is paired with another.
    """
    per_day = calls.groupBy("account", "day").agg(F.count_distinct("interaction_id").alias("n"))
    before = F.lag("day").over(Window.partitionBy("account").orderBy("day"))
    solved = flag(before.isNull() | (F.datediff("day", before) > days))
    marked = per_day.withColumn("solved", solved)
    return marked.groupBy(period_of(F.col("day"), grain).alias("period")).agg(
        F.sum("solved").alias("resolved"), F.sum("n").alias("billing_calls"),
        F.round(F.try_divide(F.sum("solved"), F.sum("n")), 3).alias("ftr"))
