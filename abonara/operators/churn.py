"""Churn, transfers and rejoiners on account-period tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import boundary_day, period_of, shift_period
from abonara.functions.profile import flag, last10, movement_reason
from abonara.functions.rules import any_of, first_match
from abonara.operators.dedup import first_by

KEYS = ["period", "account"]


def inactive(pair: DataFrame) -> DataFrame:
    """Accounts active at the start and not at the end: voluntary until proven otherwise."""
    return pair.where("active_bom = 1 AND coalesce(active_eom, 0) = 0").withColumn(
        "voluntary", F.lit(V.FIXED_VOLUNTARY))


def finished_disconnects(orders: DataFrame, grain: str = "month", day: str = "completed") -> DataFrame:
    """Account-periods with a finished disconnect order, once each."""
    return (orders.where((F.col("order_type") == V.DEINSTALL) & (F.col("status") == V.FINISHED))
            .select("account", period_of(F.col(day), grain).alias("period")).distinct())


def voluntary_by_order(lost: DataFrame, orders: DataFrame, grain: str = "month") -> DataFrame:
    """Voluntary only with a finished disconnect order in this or the previous period.

    Each order month is spread to the two periods it can explain, which turns the range
    condition into an equi-join. Accounts without such an order are atypical.
    """
    explained = (
        finished_disconnects(orders, grain)
        .select("account", F.explode(F.array(
            F.col("period"), shift_period(F.col("period"), 1, grain))).alias("period"))
        .distinct().withColumn("_ordered", F.lit(1)))
    return (lost.join(explained, KEYS, "left")
            .withColumn("voluntary", F.when(F.col("_ordered") == 1, V.FIXED_VOLUNTARY)
                        .otherwise(V.FIXED_ATYPICAL))
            .drop("_ordered"))


def record_brackets(daily: DataFrame, grain: str = "month", age: str = "age_fix",
                    unpaid: str = "unpaid_dt") -> DataFrame:
    """First and last record of each account-period and the state on both."""
    day = F.col("dt")
    return (daily.groupBy("account", period_of(day, grain).alias("period"))
            .agg(F.min(day).alias("first_dt"), F.max(day).alias("last_dt"),
                 F.min_by(age, "dt").alias("first_age"), F.max_by(age, "dt").alias("last_age"),
                 F.max_by(F.datediff("dt", F.col(unpaid)), "dt").alias("last_unpaid_days")))


def crossed(age_before: Column, unpaid_before: Column, age: Column, unpaid: Column, days: int = 90) -> Column:
    """Below ``days`` at the start and at or above it at the end; the days since the oldest
    unpaid bill can overrule a stuck age on either side."""
    return ((age_before < days) | (unpaid_before < days)) & ((age >= days) | (unpaid >= days))


def involuntary(brackets: DataFrame, days: int = 90, grain: str = "month",
                boundary: str | None = None) -> DataFrame:
    """Accounts that were below ``days`` at the start and at or above it at the end.

    The start is the last record of the previous period; with ``boundary`` it must lie on
    that boundary day. See :func:`crossed`. One ordered pass per account replaces a self join; an
    account has one row per period there.
    """
    by_period = Window.partitionBy("account").orderBy("period")
    before = F.lag(F.struct("period", "last_dt", "last_age", "last_unpaid_days")).over(by_period)
    joined = brackets.withColumn("_before", before).where(
        shift_period(F.col("_before.period"), 1, grain) == F.col("period"))
    if boundary is not None:
        joined = joined.where(boundary_day(F.col("_before.last_dt"), boundary, grain))
    return joined.where(crossed(F.col("_before.last_age"), F.col("_before.last_unpaid_days"),
                                F.col("last_age"), F.col("last_unpaid_days"), days)).select(
        "period", "account", F.lit(V.FIXED_INVOLUNTARY).alias("involuntary"), "last_age")


def reached_threshold(daily: DataFrame, lost: DataFrame, days: int = 92, grain: str = "month",
                      age: str = "age") -> DataFrame:
    """Lost accounts whose highest age in the period reached the threshold."""
    peaks = (daily.groupBy("account", period_of(F.col("dt"), grain).alias("period"))
             .agg(F.max(age).alias("max_age")).where(F.col("max_age") >= days))
    return lost.select(*KEYS).join(peaks, KEYS, "inner").withColumn(
        "involuntary", F.lit(V.FIXED_INVOLUNTARY))


def merge_churn(voluntary: DataFrame, invol: DataFrame, pair: DataFrame | None = None) -> DataFrame:
    """One churn type per account-period; involuntary wins.

    With ``pair`` the types are attached to it and cleared where the account is active at
    the end of the period.
    """
    merged = (voluntary.select(*KEYS, "voluntary")
              .join(invol.select(*KEYS, "involuntary"), KEYS, "full")
              .select(*KEYS, F.coalesce("involuntary", "voluntary").alias("churn_type")))
    if pair is None:
        return merged
    return pair.join(merged, KEYS, "left").withColumn(
        "churn_type", F.when(F.col("active_eom") == 1, None).otherwise(F.col("churn_type")))


def early_disconnect(orders: DataFrame, grain: str = "month",
                     codes: Sequence[str] = V.DELINQUENCY_CODES) -> DataFrame:
    """Account-periods with a delinquency-coded disconnect order."""
    return (orders.where((F.col("order_type") == V.DEINSTALL) & F.col("command").isin(*codes))
            .select("account", period_of(F.col("start"), grain).alias("period")).distinct())


def threshold_churn(lost: DataFrame, reached: DataFrame, early: DataFrame) -> DataFrame:
    """Churn type of the order-based rule: early disconnection, involuntary, voluntary."""
    return (
        lost.select(*KEYS)
        .join(reached.select(*KEYS, F.lit(1).alias("_reached")), KEYS, "left")
        .join(early.select(*KEYS, F.lit(1).alias("_early")), KEYS, "left")
        .select(*KEYS, first_match([
            (F.col("_early") == 1, V.FIXED_EARLY),
            (F.col("_reached") == 1, V.FIXED_INVOLUNTARY),
        ], V.FIXED_VOLUNTARY).alias("churn_type")))


def contract_movements(log: DataFrame, grain: str = "month", lead: int = 1) -> DataFrame:
    """First and last movement of each contract and period of the movement log.

    The ``lead`` days before a period belong to it as well, so an entry of those days
    counts in both periods.

    ``log`` has contract, day, code, kind, description and a sequence that orders
    entries of one day. The key is the normalized contract id.
    """
    entry = F.struct("code", "kind", "description", F.col("day").alias("day"))
    order = F.struct("day", "seq")
    periods = F.array_distinct(F.array(period_of(F.col("day"), grain), period_of(F.date_add("day", lead), grain)))
    return (
        log.withColumn("period", F.explode(periods)).groupBy(last10(F.col("contract")).alias("key"), "period")
        .agg(F.min_by(entry, order).alias("f"), F.max_by(entry, order).alias("l"))
        .select("key", "period",
                F.col("f.code").alias("first_code"), F.col("f.kind").alias("first_kind"),
                F.col("l.code").alias("last_code"), F.col("l.kind").alias("last_kind"),
                F.col("l.description").alias("last_description"), F.col("l.day").alias("last_day")))


def movement_log_churn(lost: DataFrame, movements: DataFrame) -> DataFrame:
    """Churn type of lost accounts from their last movement in the period."""
    reasons = movements.select("key", "period", movement_reason(
        F.col("last_code"), F.col("last_kind"), F.col("last_description")).alias("churn_type"))
    return (lost.select(*KEYS).withColumn("key", last10(F.col("account")))
            .join(reasons, ["key", "period"], "left").select(*KEYS, "churn_type"))


def transfer_balance(log: DataFrame) -> DataFrame:
    """Product switches in minus out per contract; plain conditional counts."""
    switch = lambda kind: F.count(F.when((F.col("code") == V.LOG_SWITCH) & (F.col("kind") == kind), 1))
    return log.groupBy(last10(F.col("contract")).alias("key")).agg(
        (switch(V.LOG_IN) - switch(V.LOG_OUT)).alias("balance"))


def transfer_flag(churned: DataFrame, movements: DataFrame, balances: DataFrame) -> DataFrame:
    """Transfer in or out from the movement log; ``churned`` has movement and churn type.

    Contract facts are one row per key, so one join each replaces the membership tests.
    """
    facts = movements.select("key", "period", "first_code", "first_kind", "last_code", "last_kind")
    return (
        churned.withColumn("key", last10(F.col("account")))
        .join(facts, ["key", "period"], "left")
        .join(balances, ["key"], "left")
        .withColumn("transfer_flag", transfer_rule())
        .drop("key", "first_code", "first_kind", "last_code", "last_kind", "balance"))


def transfer_rule() -> Column:
    """Transfer in or out, on rows that have movement, churn type, log entries and balance."""
    movement = F.col("main_movement")
    switched_out = (F.col("last_code") == V.LOG_SWITCH) & (F.col("last_kind") == V.LOG_OUT)
    switched_in = (F.col("first_code") == V.LOG_SWITCH) & (F.col("first_kind") == V.LOG_IN)
    return first_match([
        (F.col("churn_type").isNull() & (movement == V.LOSS) & switched_out, V.TRANSFER_OUT),
        ((movement == V.DOWNSELL) & switched_out & (F.col("balance") < 0), V.TRANSFER_OUT),
        ((movement == V.NEW) & switched_in, V.TRANSFER_IN),
        # The balance counts only for contracts that moved in the period at all.
        ((movement == V.UPSELL) & F.col("last_code").isNotNull() & (F.col("balance") > 0),
         V.TRANSFER_IN),
    ])


def transfer_flag_by_orders(churned: DataFrame, orders: DataFrame, grain: str = "month") -> DataFrame:
    """Transfer in or out from coded service orders completed in the period."""
    command = F.col("command")
    out = (F.col("order_type") == V.DEINSTALL) & (
        command.isin(*V.TRANSFER_OUT_CODES) | command.startswith(V.TRANSFER_OUT_PREFIX))
    into = (F.col("order_type") == V.INSTALL) & command.isin(*V.TRANSFER_IN_CODES)
    facts = (orders.groupBy(last10(F.col("account")).alias("key"),
                            period_of(F.col("completed"), grain).alias("period"))
             .agg(F.max(flag(out)).alias("_out"), F.max(flag(into)).alias("_in")))
    movement = F.col("main_movement")
    leaves = (F.col("churn_type") == V.FIXED_VOLUNTARY) | (movement == V.DOWNSELL)
    return (churned.withColumn("key", last10(F.col("account")))
            .join(facts, ["key", "period"], "left")
            .withColumn("transfer_flag", first_match([
                (leaves & (F.col("_out") == 1), V.TRANSFER_OUT),
                (movement.isin(V.UPSELL, V.NEW) & (F.col("_in") == 1), V.TRANSFER_IN)]))
            .drop("key", "_out", "_in"))


def mobile_churn(pair: DataFrame, movements: DataFrame, grain: str = "month") -> DataFrame:
    """Type of mobile losses from the movement file of the same period.

    ``movements`` has mobile_account, day and churn_type. Several movements of one
    account-period would repeat rows, so one is kept: the lowest label, involuntary last.
    """
    typed = (movements.where(F.col("churn_type").isNotNull())
             .groupBy("mobile_account", period_of(F.col("day"), grain).alias("period"))
             .agg(F.min("churn_type").alias("_type")))
    lost = (F.col("active_bom") == 1) & (F.col("active_eom") == 0)
    return (pair.join(typed, ["mobile_account", "period"], "left")
            .withColumn("mobile_churn_type", F.when(lost, F.col("_type")))
            .withColumn("mobile_churn_flag", F.coalesce("mobile_churn_type", F.lit(V.MOBILE_STAYS)))
            .withColumn("mobile_rgu_churn", flag(F.col("mobile_churn_type").isNotNull()))
            .drop("_type"))


def type_labels(mapping: dict[str, str], key: Column) -> Column:
    return first_match([(key == k, v) for k, v in mapping.items()])


def rejoiners(churned: DataFrame, ages: DataFrame, days: int = 90, grain: str = "month") -> DataFrame:
    """Accounts that churned in one period and are present and paying in the next, typed.

    ``ages`` has one row per account and day with ``age_fix`` and ``last_pay_dt``; an
    account is back when its age is at most ``days``, or unknown with a payment in the
    period.
    """
    period = period_of(F.col("dt"), grain)
    back = (F.col("age_fix") <= days) | (
        F.col("age_fix").isNull() & (period_of(F.col("last_pay_dt"), grain) == period))
    present = ages.where(back).select("account", period.alias("period")).distinct()
    left = churned.where(F.col("churn_type").isNotNull()).select(
        "account", shift_period(F.col("period"), 1, grain).alias("period"), "churn_type")
    return left.join(present, KEYS, "left_semi").select(
        "period", "account", type_labels(V.FIXED_REJOINERS, F.col("churn_type")).alias("rejoiner_type"))


def mobile_rejoiners(churned: DataFrame, grain: str = "month") -> DataFrame:
    """Attach the rejoiner type to mobile accounts that churned one period ago.

    One ordered pass per account; it has one row per period there.
    """
    by_period = Window.partitionBy("mobile_account").orderBy("period")
    before = F.lag(F.struct("period", "mobile_churn_type")).over(by_period)
    return (churned.withColumn("_before", before)
            .withColumn("mobile_rejoiner_type", F.when(
                shift_period(F.col("_before.period"), 1, grain) == F.col("period"),
                type_labels(V.MOBILE_REJOINERS, F.col("_before.mobile_churn_type"))))
            .drop("_before"))


def rejoiner_simple(pair: DataFrame, lost: DataFrame, grain: str = "month") -> DataFrame:
    """Flag accounts of ``pair`` that are in ``lost`` one period earlier."""
    gone = (lost.select("account", shift_period(F.col("period"), 1, grain).alias("period"))
            .distinct().withColumn("_gone", F.lit(1)))
    return (pair.join(gone, KEYS, "left")
            .withColumn("rejoiner_flag", F.when(F.col("_gone") == 1, "Rejoiner")).drop("_gone"))


def period_rgus(daily: DataFrame, grain: str = "month") -> DataFrame:
    """RGUs an account held at any time in the period: one per line with any name."""
    held = lambda c: flag(F.count(c) > 0)
    return (daily.groupBy("account", period_of(F.col("dt"), grain).alias("period"))
            .agg((held("vo_nm") + held("bb_nm") + held("tv_nm")).alias("held_rgus")))


def first_seen_rgus(daily: DataFrame) -> DataFrame:
    """RGUs on the first day of an account (named a maximum in the scripts, but first)."""
    named = lambda c: flag(F.col(c).isNotNull())
    return first_by(daily, ["account"], ["dt"],
                    {"first_rgus": named("vo_nm") + named("bb_nm") + named("tv_nm")})


def rgu_churn(churn_type: Column, movement: Column, invol_rgus: Column, vol_rgus: Column,
              b_rgus: Column, e_rgus: Column) -> Column:
    """RGUs lost in the period by kind of loss; zero without one."""
    return (F.when(churn_type == V.FIXED_INVOLUNTARY, invol_rgus)
            .when(churn_type == V.FIXED_VOLUNTARY, vol_rgus)
            .when(movement == V.DOWNSELL, b_rgus - e_rgus)
            .otherwise(0))


def max_rgus(daily: DataFrame, grain: str = "month", span: int = 2) -> DataFrame:
    """Most RGUs per line over the period and the ``span - 1`` before it.

    Period maxima are spread forward and regrouped; ``span`` rows per key at most.
    """
    line_flags = {f"max_rgu_{n}": F.max(flag(F.col(f"{n}_nm").isNotNull())) for n in ("vo", "tv", "bb")}
    own = (daily.groupBy("account", period_of(F.col("dt"), grain).alias("period"))
           .agg(*[c.alias(n) for n, c in line_flags.items()]))
    spread = own.withColumn("period", F.explode(F.array(
        *[shift_period(F.col("period"), i, grain) for i in range(span)])))
    return (spread.groupBy("account", "period")
            .agg(*[F.max(n).alias(n) for n in line_flags])
            .withColumn("max_rgus", sum(F.col(n) for n in line_flags)))


def churned_rgus(churners: DataFrame, best: DataFrame) -> DataFrame:
    """Attach the best RGU count to churners and what is left of it at the end."""
    return churners.join(best.select(*KEYS, "max_rgus"), KEYS, "left").withColumn(
        "churned_rgus", F.col("max_rgus") - F.coalesce("e_num_rgus", F.lit(0)))


def churner_profile(churners: DataFrame, daily: DataFrame, grain: str = "month",
                    age: str = "age") -> DataFrame:
    """Lowest and highest age of the period, for churners that have records in it."""
    ages = (daily.groupBy("account", period_of(F.col("dt"), grain).alias("period"))
            .agg(F.min(age).alias("min_age"), F.max(age).alias("max_age")))
    return churners.join(ages, KEYS, "inner")


def last_active_day(daily: DataFrame, scan: tuple[Column, Column], report: tuple[Column, Column],
                    days: int = 90) -> DataFrame:
    """Accounts per last day on which they were active, for days inside ``report``."""
    active = daily.where(F.col("dt").between(*scan) & (F.col("age") < days))
    last = active.groupBy("account").agg(F.max("dt").alias("last_day"))
    return (last.where(F.col("last_day").between(*report))
            .groupBy("last_day").agg(F.count("*").alias("churners")))


def churners_or_downsells(table: DataFrame) -> DataFrame:
    """Rows that lost RGUs: voluntary and involuntary churners and downsells."""
    return table.where(any_of([
        F.col("churn_type").isin(V.FIXED_VOLUNTARY, V.FIXED_INVOLUNTARY),
        F.col("main_movement") == V.DOWNSELL]))
