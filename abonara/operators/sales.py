"""New customers, sales and upsells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import in_period, period_of, shift_period
from abonara.functions.profile import collapse_channel, flag
from abonara.functions.rules import first_match
from abonara.operators.dedup import densest_entry_day, first_by


def first_seen(snap: DataFrame) -> DataFrame:
    """First snapshot day and first installation of each account."""
    return snap.groupBy("account").agg(
        F.min("dt").alias("first_day"), F.min("inst_dt").alias("first_install"))


def new_by_absence(snap: DataFrame, period: Column, back: int = 3, grain: str = "month") -> DataFrame:
    """Accounts present in the period and absent from the ``back`` periods before it.

    One pass with two flags per account instead of an anti join of two scans.
    """
    day = F.col("dt")
    window = snap.where(in_period(day, period, grain)
                        | ((day >= shift_period(period, -back, grain)) & (day < period)))
    seen = window.where(F.col("account").isNotNull()).groupBy("account").agg(
        F.max(flag(day >= period)).alias("now"), F.max(flag(day < period)).alias("before"),
        F.min(F.when(day >= period, day)).alias("first_day"))
    return seen.where("now = 1 AND before = 0").select("account", "first_day")


def new_by_first_seen(snap: DataFrame, period: Column, back: int = 6, ahead: int = 1,
                      grain: str = "month") -> DataFrame:
    """Accounts whose first day inside the look-back window falls in the period."""
    day = F.col("dt")
    window = snap.where(day.between(shift_period(period, -back, grain), shift_period(period, ahead, grain)))
    first = window.groupBy("account").agg(F.min(day).alias("first_day"))
    return first.where(in_period(F.col("first_day"), period, grain))


def new_by_connect(snap: DataFrame, period: Column, back: int = 0, grain: str = "month",
                   connect: str = "inst_dt", span: int = 3) -> DataFrame:
    """Accounts whose latest known connect date lies in the period ``back`` before.

    Only rows up to the end of the period with a connect date in it or in the ``span``
    periods before count, so a later run of an old period gives the same answer. No row is older
    than the connect date it tells, so older days are not read.
    """
    start, end = shift_period(period, -span, grain), F.date_sub(shift_period(period, 1, grain), 1)
    seen = snap.where(F.col("dt").between(start, end) & F.col(connect).between(start, end))
    latest = seen.groupBy("account").agg(F.max_by(connect, "dt").alias("connect_dt"))
    return latest.where(in_period(F.col("connect_dt"), shift_period(period, -back, grain), grain)).withColumn(
        "install_period", period_of(F.col("connect_dt"), grain))


def first_finished_install(orders: DataFrame) -> DataFrame:
    """First finished installation order per account, by completion."""
    done = orders.where((F.col("order_type") == V.INSTALL) & (F.col("status") == V.FINISHED))
    return first_by(done, ["account"], [F.coalesce("completed", F.to_date(F.lit("9999-12-31"))), "order_id"], {
        "order_id": F.col("order_id"), "order_start": F.col("start"), "order_done": F.col("completed")})


def sale_from_orders(orders: DataFrame, snap: DataFrame, first: Column, last: Column,
                     grain: str = "month") -> DataFrame:
    """Sales: the first finished installation, not later than the account's appearance.

    The appearance is the earlier of first snapshot day and first installation. Orders
    that start outside ``first`` to ``last`` are no sales of the run.
    """
    joined = first_finished_install(orders).join(first_seen(snap), "account")
    sale = period_of(F.col("order_done"), grain)
    appears = period_of(F.least("first_day", "first_install"), grain)
    return (joined
            .where(period_of(F.col("order_start"), grain).between(first, last) & (sale <= appears))
            .withColumn("period", sale)
            .withColumn("sale_kind", F.when(sale < appears, "DNA data delayed").otherwise("Mismo mes")))


def sale_date(snap: DataFrame, grain: str = "month") -> DataFrame:
    """Older rule: the later of installation period and first-seen period, per installation."""
    rows = snap.groupBy("account", period_of(F.col("inst_dt"), grain).alias("install_period")).agg(
        F.min("dt").alias("_first"))
    first = snap.groupBy("account").agg(F.min("dt").alias("first_day"))
    return rows.drop("_first").join(first, "account").withColumn(
        "sale_period", F.greatest("install_period", period_of(F.col("first_day"), grain)))


def first_sale_attrs(gross_adds: DataFrame, period: Column | None = None, grain: str = "month") -> DataFrame:
    """Channel, seller and RGUs of an account's first sale; several sales go to the first.

    Empty and null sale days are no sales. ``period`` limits to one run period.
    """
    day = F.try_to_date(F.col("sales_day"), "yyyy-MM-dd")
    sold = gross_adds.where((F.col("sales_day") != "")).withColumn("sale_day", day)
    if period is not None:
        sold = sold.where(in_period(F.col("sale_day"), period, grain))
    return first_by(sold, ["account"], ["sale_day", "sale_id"], {
        "sale_day": F.col("sale_day"), "channel": F.col("channel"), "seller": F.col("seller"),
        "sold_rgus": F.expr("try_cast(rgus_sold_text AS int)")})


def first_install(snap: DataFrame, newcomers: DataFrame) -> DataFrame:
    """First installation on or after the account's first day."""
    return (snap.join(newcomers.select("account", "first_day"), "account")
            .where(F.col("inst_dt") >= F.col("first_day"))
            .groupBy("account").agg(F.min("inst_dt").alias("first_install")))


def densest_day_cohort(sales: DataFrame, grain: str = "month") -> DataFrame:
    """Sales that entered on the day on which most accounts of their period entered."""
    day = densest_entry_day(sales, "first_day", grain).select("period", "first_day", "accounts")
    return (sales.withColumn("period", period_of(F.col("first_day"), grain))
            .join(day, ["period", "first_day"], "inner"))


def soft_dx(ages: DataFrame, cohort: DataFrame, soft: int = 26, hard: int = 90) -> DataFrame:
    """Soft disconnects and never-paid accounts of a cohort by their highest repaired age.

    Only rows of the cohort's accounts are aggregated.
    """
    own = ages.join(cohort.select("account"), "account", "left_semi")
    peaks = own.groupBy("account").agg(F.max("age_fix").alias("max_age"))
    age = F.col("max_age")
    return (cohort.select("period", "account").join(peaks, "account", "left")
            .withColumns({"soft_dx": F.when((age >= soft) & (age < hard), F.col("account")),
                          "never_paid": F.when(age >= hard, F.col("account"))}))


def soft_dx_first_bill(ages: DataFrame, soft: int = 26, hard: int = 90, grain: str = "month") -> DataFrame:
    """Older rule: highest age while the oldest unpaid bill is of the first bill's period."""
    first = ages.groupBy("account").agg(
        F.min("bill_dt").alias("first_bill"), F.min("start_dt").alias("start"))
    own = ages.join(first, "account").where(
        period_of(F.col("first_bill"), grain) == period_of(F.col("unpaid_dt"), grain))
    age = F.col("max_age")
    return (own.groupBy(period_of(F.col("start"), grain).alias("sale_period"), "account")
            .agg(F.max("age_fix").alias("max_age"))
            .withColumns({"soft_dx": F.when(age >= soft, F.col("account")),
                          "never_paid": F.when(age >= hard, F.col("account"))}))


def soft_hard_dx(snap: DataFrame, as_of: Column, cutover: Column, soft_age: int = 46, soft_overdue: int = 5,
                 hard_age: int = 90, grain: str = "month") -> DataFrame:
    """Soft and hard disconnect on the first bill.

    The first bill is the oldest unpaid date of the account's first day with something
    unpaid. Over the days on which it still is the oldest unpaid bill, the highest age
    and overdue age decide; accounts installed from ``cutover`` on use the overdue age.
    """
    owing = snap.where(F.col("age").isNotNull())
    first = first_by(owing, ["account"], ["dt"], {
        "unpaid_dt": F.col("unpaid_dt"), "install": F.col("inst_dt")})
    peaks = (owing.join(first, ["account", "unpaid_dt"])
             .groupBy("account", "unpaid_dt", "install")
             .agg(F.max("age").alias("max_age"), F.max("overdue").alias("max_overdue"),
                  F.max("dt").alias("last_day")))
    started = period_of(F.col("install"), grain)
    soft = F.when(started < cutover, F.col("max_age") >= soft_age).otherwise(F.col("max_overdue") >= soft_overdue)
    return peaks.withColumns({
        "install_period": started,
        "soft_dx": flag(soft), "hard_dx": flag(F.col("max_age") >= hard_age),
        "soft_window_done": flag(F.date_add("unpaid_dt", soft_age) < as_of),
        "hard_window_done": flag(F.date_add("unpaid_dt", hard_age) < as_of),
    })


NAMES = ("bb_nm", "vo_nm", "tv_nm")


def newcomers_and_upsells(snap: DataFrame, period: Column, back: int = 6, ahead: int = 1, grain: str = "month") -> DataFrame:
    """Gross adds and upsell candidates of a period from one scan.

    An account whose first day inside the look-back window lies in the period is new (``base``
    Gross-add). Any other account with rows in the period is a candidate (Upsell): its first and
    last products, the change between them, and ``reached_on``, the first day on which the RGU count
    ``mix_qty`` had its final value. Rows are reduced to one per account and RGU count before
    those of an account are put together.
    """
    day, inside = F.col("dt"), in_period(F.col("dt"), period, grain)
    window = day.between(shift_period(period, -back, grain), shift_period(period, ahead, grain))
    entry = F.when(inside, F.struct(F.struct("dt", "row_id").alias("by"), F.struct("mix_qty", "mrc", *NAMES).alias("s")))
    by_count = snap.where(window | inside).groupBy("account", "mix_qty").agg(
        F.min(F.when(window, day)).alias("seen"), F.min(F.when(inside, day)).alias("on"),
        F.min(entry).alias("f"), F.max(entry).alias("l"))
    ends = by_count.groupBy("account").agg(
        F.min("seen").alias("seen"), F.min("f").alias("f"), F.max("l").alias("l"),
        F.collect_list(F.struct("mix_qty", "on")).alias("counts"))  # one entry per RGU count
    new = F.coalesce(in_period(F.col("seen"), period, grain), F.lit(False))
    at = lambda side, c: F.col(f"{side}.s.{c}")
    more = at("l", "mix_qty") - at("f", "mix_qty")
    named = lambda side: sum(flag(at(side, n).isNotNull()) for n in NAMES)
    changed = sum(flag(F.coalesce(at("l", n), F.lit("NA")) != F.coalesce(at("f", n), F.lit("NA"))) for n in NAMES)
    final = F.filter("counts", lambda c: c["mix_qty"] == at("l", "mix_qty"))
    columns = {
        "first_mix_qty": at("f", "mix_qty"), "last_mix_qty": at("l", "mix_qty"),
        "first_named_rgus": named("f"), "last_named_rgus": named("l"), "changed_products": changed,
        "mrc_change": F.round(at("l", "mrc") - at("f", "mrc"), 2),
        "reached_on": F.array_min(F.transform(final, lambda c: c["on"])),
        "upsell_kind": F.when(more > 0, "Upsell").otherwise("Other"), "upsell_rgus": more,
        "upsell_named_rgus": named("l") - named("f"), "product_changed": changed > 0,
    }
    return ends.where(new | F.col("f").isNotNull()).select(
        "account", F.when(new, "Gross-add").otherwise("Upsell").alias("base"),
        *[F.when(~new, c).alias(n) for n, c in columns.items()])


def sales_flags(merged: DataFrame) -> DataFrame:
    """Movement, bundle size and RGUs before, after and sold.

    ``merged`` has max_rgus (gross adds), first_mix_qty, last_mix_qty and sold_rgus.
    """
    gross = F.col("base") == "Gross-add"
    upsold = (F.col("upsell_kind") == "Upsell") & (F.col("upsell_rgus") > 0)
    size = F.when(gross, F.col("max_rgus")).otherwise(F.col("first_mix_qty"))
    movement = first_match([(gross, "Gross Add"), (upsold, "Upsell")], "Other")
    return merged.withColumns({
        "movement": movement,
        "bundle": F.when(size.between(1, 3), F.concat(size.cast("string"), F.lit("P"))),
        "first_rgus": F.when(gross, 0).otherwise(F.col("first_mix_qty")),
        "last_rgus": F.when(gross, F.col("max_rgus")).otherwise(F.col("last_mix_qty")),
        "rgus_counted": first_match([
            (gross, F.col("max_rgus")),
            (upsold, F.col("last_mix_qty") - F.col("first_mix_qty")),
        ], F.col("sold_rgus")),
        "channel_group": collapse_channel(F.col("channel"), ("D2D",)),
    })


def rgu_compare(flagged: DataFrame) -> DataFrame:
    """Sales whose reported and counted RGUs differ, and which side is greater."""
    reported, counted = F.col("sold_rgus"), F.col("rgus_counted")
    return flagged.where(reported != counted).withColumn(
        "greater", F.when(reported > counted, "reported").otherwise("counted"))

