"""Sales cohorts followed over the periods after the sale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions.calendar import period_index, period_of, shift_period
from abonara.functions.profile import flag
from abonara.operators.dedup import first_non_null, keep_one


def _followed(sales: DataFrame, closing: DataFrame, n: int, grain: str) -> DataFrame:
    """Closing rows of sold accounts with ``k``, the periods since the sale (0 to n)."""
    joined = closing.join(sales.select("account", "sale_period"), "account")
    k = period_index(F.col("sale_period"), F.col("period"), grain)
    return joined.withColumn("k", k).where(F.col("k").between(0, n))


def survival_panel(sales: DataFrame, closing: DataFrame, n: int = 12, grain: str = "month",
                   max_age: int = 90, live: Column | None = None, gap_periods: Sequence[str] = (),
                   keep_missing: bool = False) -> DataFrame:
    """One row per sold account with ``surv_k`` (1 or null) and ``age_k`` for k = 0..n.

    An account survives period k when its closing row is below ``max_age``. ``live`` is
    an optional predicate on the row (account state, mix). In ``gap_periods`` the source
    had no data; accounts seen at all count as survivors there. Sold accounts without any
    row appear only with ``keep_missing``. One conditional aggregate replaces a pivot.
    """
    rows = closing if live is None else closing.where(live)
    rows = _followed(sales, rows, n, grain)
    alive = F.col("age").isNull() | (F.col("age") < max_age)
    at = lambda i: F.col("k") == i
    gap = lambda i: shift_period(F.col("sale_period"), i, grain).isin(
        *[F.to_date(F.lit(g)) for g in gap_periods]) if gap_periods else F.lit(False)
    aggregates = [F.max("unpaid_dt").alias("max_unpaid_dt")]
    for i in range(n + 1):
        aggregates.append(F.max(F.when((at(i) & alive) | gap(i), 1)).alias(f"surv_{i}"))
        aggregates.append(F.max(F.when(at(i), F.col("age"))).alias(f"age_{i}"))
    panel = rows.groupBy("account", "sale_period").agg(*aggregates)
    if keep_missing:
        panel = sales.select("account", "sale_period").join(panel, ["account", "sale_period"], "left")
    return panel


def churn_month(panel: DataFrame, as_of: Column, n: int = 12, grain: str = "month") -> DataFrame:
    """Add ``churn_k``: alive at k-1 and gone at k, for periods that are over on ``as_of``."""
    columns = {"churn_0": F.when(F.col("surv_0").isNull(), 1)}
    for k in range(1, n + 1):
        over = shift_period(F.col("sale_period"), k, grain) < period_of(as_of, grain)
        columns[f"churn_{k}"] = F.when(
            (F.col(f"surv_{k - 1}") == 1) & F.col(f"surv_{k}").isNull() & over, 1)
    return panel.withColumns(columns)


def churn_type(panel: DataFrame, n: int = 12, days: int = 90) -> DataFrame:
    """Add ``churn_type_k``: involuntary at or above ``days``, else voluntary.

    The scripts mix the period indices in this step; every test here is about period k.
    """
    return panel.withColumns({
        f"churn_type_{k}": F.when(F.col(f"churn_{k}") == 1, F.when(
            F.col(f"age_{k}") >= days, "Involuntary").otherwise("Voluntary"))
        for k in range(n + 1)})


def mortality(panel: DataFrame, sales: DataFrame, horizon: int = 6, skip: Sequence[str] = ()) -> DataFrame:
    """Attach sale attributes and ``churned`` (1 when not alive at the horizon).

    Cohorts in ``skip`` are known to be incomplete and never count as churned.
    """
    skipped = F.col("sale_period").isin(*[F.to_date(F.lit(s)) for s in skip]) if skip else F.lit(False)
    return sales.join(panel, ["account", "sale_period"]).withColumn(
        "churned", flag(F.col(f"surv_{horizon}").isNull() & ~skipped))


def first_n_bills(rows: DataFrame, n: int = 3, grain: str = "month") -> DataFrame:
    """First bills of an account, one per period: date, amount and number 1..n."""
    per_period = (rows.groupBy("account", period_of(F.col("dt"), grain).alias("period"))
                  .agg(first_non_null(F.struct("bill_dt", "bill_amt"),
                                      F.when(F.col("bill_dt").isNotNull(), F.col("dt"))).alias("b"))
                  .where(F.col("b.bill_dt").isNotNull()))
    nth = F.row_number().over(Window.partitionBy("account").orderBy("period"))
    return per_period.withColumn("nth", nth).where(F.col("nth") <= n).select(
        "account", "nth", F.col("b.bill_dt").alias("bill_dt"), F.col("b.bill_amt").alias("bill_amt"))


def nth_bill_overdue(rows: DataFrame, bills: DataFrame, n: int = 3) -> DataFrame:
    """Highest and lowest age while the k-th bill is the oldest unpaid one.

    A bill is the oldest unpaid one from the day after its date. One join on account and
    date serves all k.
    """
    unpaid = bills.select("account", "nth", F.date_add("bill_dt", 1).alias("unpaid_dt"))
    joined = rows.select("account", "dt", "age", "unpaid_dt").join(unpaid, ["account", "unpaid_dt"])
    of = lambda k, c: F.when(F.col("nth") == k, F.col(c))
    aggregates = []
    for k in range(1, n + 1):
        aggregates += [F.max(of(k, "age")).alias(f"max_age_bill_{k}"), F.min(of(k, "age")).alias(f"min_age_bill_{k}"),
                       F.max(of(k, "dt")).alias(f"last_day_bill_{k}"), F.max(of(k, "unpaid_dt")).alias(f"unpaid_bill_{k}")]
    return joined.groupBy("account").agg(*aggregates)


def bill_cohort_flags(mortal: DataFrame, overdue: DataFrame, n: int = 3, days: int = 90, grace: int = 2) -> DataFrame:
    """Churn and rejoin at each bill, and the voluntary remainder.

    A rejoiner at a bill later had a newer bill as its oldest unpaid one.
    """
    joined = mortal.join(overdue, "account", "left")
    columns, at_bill = {}, []
    for k in range(1, n + 1):
        hit = (F.col(f"max_age_bill_{k}") >= days) & (F.col("churned") == 1)
        newer = F.datediff("max_unpaid_dt", f"unpaid_bill_{k}") > grace
        columns[f"churn_bill_{k}"] = flag(hit)
        columns[f"rejoin_bill_{k}"] = flag(hit & newer)
        at_bill.append(F.coalesce(hit, F.lit(False)))
    none = ~at_bill[0]
    for hit in at_bill[1:]:
        none = none & ~hit
    columns["voluntary"] = flag((F.col("churned") == 1) & none)
    return joined.withColumns(columns)


def arpu_panel(sales: DataFrame, closing: DataFrame, n: int = 12, grain: str = "month",
               live: Column | None = None) -> DataFrame:
    """Highest charge and RGU count of each sold account per period after the sale."""
    rows = closing if live is None else closing.where(live)
    rows = _followed(sales, rows, n, grain)
    at = lambda i, c: F.max(F.when(F.col("k") == i, F.col(c)))
    return rows.groupBy("account", "sale_period").agg(
        *[at(i, "mrc").alias(f"mrc_{i}") for i in range(n + 1)],
        *[at(i, "num_rgus").alias(f"rgus_{i}") for i in range(n + 1)])


def attach_agent(sales: DataFrame, attributes: DataFrame, payers: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Attach the account attributes of the sale period and the deposit flag; one row each."""
    listed = payers.select("account").distinct().withColumn("_paid", F.lit(1))
    joined = (sales.join(attributes.withColumnRenamed("period", "sale_period"), ["account", "sale_period"], "left")
              .join(listed, "account", "left").withColumn("deposit_paid", F.when(F.col("_paid") == 1, F.col("account")))
              .drop("_paid"))
    return keep_one(joined, ["sale_period", "account"], list(order))


def cohort_rollup(flags: DataFrame, dims: Sequence[str], n: int = 3, rgus: str = "rgus_sold") -> DataFrame:
    """Sales, churners and rejoiners by bill and the voluntary rest, in accounts and RGUs."""
    weighted = lambda c: F.sum(F.when(F.col(c) == 1, F.col(rgus)))
    names = [f"{kind}_bill_{k}" for k in range(1, n + 1) for kind in ("churn", "rejoin")] + ["voluntary"]
    return flags.groupBy(*dims).agg(
        F.count_distinct("account").alias("sales"),
        *[F.sum(c).alias(f"{c}_accounts") for c in names],
        F.sum(rgus).alias("sales_rgus"),
        *[weighted(c).alias(f"{c}_rgus") for c in names])


def survival_curve(panel: DataFrame, n: int = 12) -> DataFrame:
    """Accounts and survivors per period since the sale, per cohort."""
    return panel.groupBy("sale_period").agg(
        F.count("*").alias("accounts"), *[F.sum(f"surv_{k}").alias(f"alive_{k}") for k in range(n + 1)])
