"""First bills, payment windows and never-paid flags.

Windows are data: a horizon maps the first bill date to its closing day, so month windows
(``add_months``) and day windows (``date_add``) share the code. The account's cycle row
is unique, so each join below has a one-row side and cannot multiply rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from abonara.operators.dedup import first_non_null

Until = Callable[[Column], Column]


def months(n: int) -> Until:
    """Up to and including the same day ``n`` months later.

    The scripts add to month numbers, which breaks in December; this does not.
    """
    return lambda start: F.add_months(start, n)


def days(n: int) -> Until:
    """The ``n`` days from the start on (day ``n`` itself excluded)."""
    return lambda start: F.date_add(start, n - 1)


def first_bill(rows: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """First known bill date of each account, by snapshot day.

    With ``since`` (account, since_dt) only bills dated from that day on count and the
    earliest one is taken.
    """
    if since is None:
        return (rows.groupBy("account")
                .agg(first_non_null(F.col("bill_dt"), F.struct("dt", "row_id")).alias("first_bill"))
                .where(F.col("first_bill").isNotNull()))
    return (rows.join(since, "account").where(F.col("bill_dt") >= F.col("since_dt"))
            .groupBy("account").agg(F.min("bill_dt").alias("first_bill")))


def max_mrc_window(rows: DataFrame, bills: DataFrame, until: Until) -> DataFrame:
    """Highest charge, and the distinct charges in falling order, from the first bill on.

    An account has one charge a day, the highest of it, so the list is bounded by the days of the
    window.
    """
    daily = rows.groupBy("account", "dt").agg(F.max("mrc").alias("mrc"))
    inside = daily.join(bills, "account").where(
        F.col("dt").between(F.col("first_bill"), until(F.col("first_bill"))))
    return inside.groupBy("account", "first_bill").agg(
        F.max("mrc").alias("max_mrc"), F.sort_array(F.collect_set("mrc"), asc=False).alias("mrcs"))


def first_cycle(rows: DataFrame, mrc: DataFrame, as_of: Column | None = None) -> DataFrame:
    """First-cycle facts per account from the rows that carry the first bill."""
    own = rows.withColumnRenamed("bill_dt", "first_bill").drop("mrc").join(mrc, ["account", "first_bill"])
    cycle = own.groupBy("account").agg(
        F.min("first_bill").alias("first_bill"), F.max("mix_qty").alias("max_rgus"),
        F.min("dt").alias("first_day"), F.max("max_mrc").alias("max_mrc"))
    if as_of is not None:
        cycle = cycle.withColumn("days_since_bill", F.datediff(as_of, F.col("first_bill")))
    return cycle


def payment_windows(payments: DataFrame, cycle: DataFrame, horizons: dict[str, Until],
                    look_back: int, longest: Until) -> DataFrame:
    """Payment sums per horizon and first, last and first sufficient payment per account.

    Deposits up to ``look_back`` days before the first bill count. Amounts are text;
    unreadable ones are ignored.
    """
    first, day = F.col("first_bill"), F.col("dt")
    paid = (
        payments.withColumn("amount", F.expr("try_cast(amount_text AS double)")).drop("amount_text")
        .join(cycle.select("account", "first_bill", "max_mrc"), "account")
        .where(day.between(F.date_sub(first, look_back), longest(first))))
    enough = F.when(F.col("amount") >= F.col("max_mrc"), F.struct("dt", "payment_id"))
    sums = [F.round(F.sum(F.when(day <= until(first), F.col("amount"))), 2).alias(f"paid_{name}")
            for name, until in horizons.items()]
    return paid.groupBy("account").agg(
        F.min("dt").alias("first_pay"), F.max("dt").alias("last_pay"),
        F.min_by("amount", F.struct("dt", "payment_id")).alias("first_amount"),
        F.min(enough).alias("_enough"), F.min_by("amount", enough).alias("enough_amount"),
        F.round(F.sum("amount"), 2).alias("paid_total"), *sums,
    ).withColumn("enough_day", F.col("_enough.dt")).drop("_enough")


def npn_flags(cycle: DataFrame, paid: DataFrame, horizons: list[str], never: int | None = None) -> DataFrame:
    """Never-paid flag per horizon: nothing paid, or less than the highest charge.

    ``days_unpaid`` counts from the first bill to the first sufficient payment; accounts
    without one get ``never``.
    """
    return npn_columns(cycle.join(paid, "account", "left"), horizons, never)


def npn_columns(facts: DataFrame, horizons: list[str], never: int | None = None) -> DataFrame:
    """The flags of :func:`npn_flags` on rows that have cycle and payments together."""
    short = lambda c: F.when(F.col(c).isNull() | (F.col(c) < F.col("max_mrc")), F.col("account"))
    flags = {f"npn_{h}": short(f"paid_{h}") for h in horizons} | {"npn": short("paid_total")}
    waited = F.datediff("enough_day", "first_bill")
    if never is not None:
        waited = F.coalesce(waited, F.lit(never))
    return facts.withColumns(flags | {"days_unpaid": waited})


def window_complete(df: DataFrame, as_of: Column, limits: list[int]) -> DataFrame:
    """Is each observation window over on ``as_of``? A label and an account column each."""
    since = F.datediff(as_of, F.col("first_bill"))
    columns = {}
    for n in limits:
        columns[f"window_{n}"] = F.when(since > n, f"Completed {n} Days").otherwise(f"Uncomplete {n} days")
        columns[f"complete_{n}"] = F.when(since >= n, F.col("account"))
    return df.withColumns(columns)

