"""Bills, charges and payments of an account as one stream of day rows.

A day row is what an account was charged or paid on a day: charges per bill date, payments in
total. Days are aggregated before they are brought together, so an account brings a row per day and
bill date however many records it has. On the stream one pass finds the first bill (or the first
after an anchor day), the highest charge after it, and every payment window; no facts are joined
back to bills or payments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.operators.billing import Until


def day_rows(bills: DataFrame, payments: DataFrame) -> DataFrame:
    """Stream rows (account, dt): charges by bill date and, in rows of their own, the day's payments.

    Amounts are text; an unreadable one counts as a payment of unknown amount.
    """
    charged = bills.groupBy("account", "dt", "bill_dt").agg(
        F.min("row_id").alias("row_id"), F.max("mrc").alias("mrc"), F.max("mix_qty").alias("mix_qty"))
    amount = F.expr("try_cast(amount_text AS double)")
    paid = payments.groupBy("account", "dt").agg(
        F.sum(amount).alias("paid"), F.max(amount).alias("most"),
        F.min_by(F.struct(amount.alias("amount")), "payment_id").alias("first"))
    return charged.unionByName(paid, allowMissingColumns=True).withColumn("is_bill", F.col("first").isNull())


def billing_facts(stream: DataFrame, horizons: Mapping[str, Until], charge_until: Until,
                  look_back: int | Column, longest: Until,
                  since: Column | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """First cycle and payment windows per account, from :func:`day_rows`.

    ``since`` is a column of the stream, the same on all rows of an account: where it is not null
    only bills dated from it on count, and the earliest is taken; elsewhere the first known one by
    day. ``carried`` columns are such columns too and come back. Accounts without a first bill, or
    without a charge row in the charge window, are left out. Columns: first_bill, max_rgus and
    first_day of the rows that carry the first bill, max_mrc, first_pay, last_pay, first_amount,
    enough_day (first day with a payment of at least max_mrc), paid_total and paid_{horizon}.
    """
    of = Window.partitionBy("account")
    day, bill, first = F.col("dt"), F.col("bill_dt"), F.col("first_bill")
    earliest = F.min(F.when(F.col("is_bill") & bill.isNotNull(), F.struct("dt", "row_id", "bill_dt"))).over(of)["bill_dt"]
    if since is not None:
        earliest = F.when(since.isNull(), earliest).otherwise(F.min(F.when(bill >= since, bill)).over(of))
    charge = F.col("is_bill") & day.between(first, charge_until(first))
    rows = stream.withColumn("first_bill", earliest).where(first.isNotNull()).withColumns({
        "max_mrc": F.max(F.when(charge, F.col("mrc"))).over(of), "_charges": F.max(charge.cast("int")).over(of)})
    own = F.col("is_bill") & (bill == first)
    window = ~F.col("is_bill") & day.between(F.date_sub(first, look_back), longest(first))
    within = lambda c, more=F.lit(True): F.when(window & more, c)
    sums = {"paid_total": within(F.col("paid"))} | {
        f"paid_{name}": within(F.col("paid"), day <= until(first)) for name, until in horizons.items()}
    facts = rows.where("_charges = 1").groupBy("account").agg(
        *[F.max(c).alias(c) for c in ("first_bill", "max_mrc", *carried)],
        F.max(F.when(own, F.col("mix_qty"))).alias("max_rgus"), F.min(F.when(own, day)).alias("first_day"),
        F.min(within(day)).alias("first_pay"), F.max(within(day)).alias("last_pay"),
        F.min(within(F.struct(day, "first"))).alias("_first"),
        F.min(within(day, F.col("most") >= F.col("max_mrc"))).alias("enough_day"),
        *[F.round(F.sum(c), 2).alias(n) for n, c in sums.items()])
    return facts.withColumn("first_amount", F.col("_first.first.amount")).drop("_first")


def first_sufficient(payments: DataFrame, facts: DataFrame) -> DataFrame:
    """The payment that first covered ``max_mrc``: its amount, looked up on ``enough_day`` alone."""
    wanted = facts.where(F.col("enough_day").isNotNull()).select("account", F.col("enough_day").alias("dt"), "max_mrc")
    amount = F.expr("try_cast(amount_text AS double)")
    return (payments.join(wanted, ["account", "dt"]).where(amount >= F.col("max_mrc"))
            .groupBy("account").agg(F.min_by(amount, "payment_id").alias("enough_amount")))
