"""Standalone questions and cross-checks between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions.calendar import period_of, shift_period
from abonara.functions.rules import any_of

LINES = ("bb", "tv", "vo")


def _with_changes(df: DataFrame, before: str) -> DataFrame:
    now, was = (lambda n: F.col(f"{n}_nm")), (lambda n: F.col(f"{before}{n}_nm"))
    return df.withColumn("changed", any_of(now(n) != was(n) for n in LINES)).withColumns({
        f"new_{n}": F.when((now(n) != was(n)) | was(n).isNull(), now(n)) for n in LINES})


def product_changes_vs_previous(daily: DataFrame) -> DataFrame:
    """Compare each row with the account's previous row, whenever that was."""
    window = Window.partitionBy("account").orderBy("dt")
    return _with_changes(daily.withColumns(
        {f"prev_{n}_nm": F.lag(f"{n}_nm").over(window) for n in LINES}), "prev_")


def product_changes(daily: DataFrame, grain: str = "day", day: str = "dt") -> DataFrame:
    """Compare each row with the account's row exactly one period earlier.

    Rows without such a neighbour are left out. The neighbour can only be the previous
    row, so one ordered pass per account replaces a self join.
    """
    window = Window.partitionBy("account").orderBy(day)
    before = F.lag(F.struct(day, *[f"{n}_nm" for n in LINES])).over(window)
    rows = daily.withColumn("_before", before).where(
        shift_period(F.col(f"_before.{day}"), 1, grain) == F.col(day))
    rows = rows.withColumns({f"prev_{n}_nm": F.col(f"_before.{n}_nm") for n in LINES}).drop("_before")
    changed = _with_changes(rows, "prev_")
    return changed.withColumn("changed", F.coalesce("changed", F.lit(False)))


KEYS = ["account", "period"]


def _present(df: DataFrame, day: str, grain: str) -> DataFrame:
    return df.select("account", period_of(F.col(day), grain).alias("period")).distinct()


def users_with_purpose(snap: DataFrame, contacts: DataFrame, purpose: str, grain: str = "month") -> DataFrame:
    """Active accounts per period that had a contact with the purpose in it.

    The script keeps its conditions in the ON clause of a left join and so counts every
    account; the accounts with such a contact are meant.
    """
    hits = _present(contacts.where(F.col("purpose") == purpose), "day", grain)
    return (_present(snap, "dt", grain).join(hits, KEYS, "left_semi")
            .groupBy("period").agg(F.count("*").alias("accounts")))


def active_with_order(snap: DataFrame, orders: DataFrame, order_type: str, days: int = 90,
                      grain: str = "month") -> DataFrame:
    """Accounts with an age below ``days`` and an order of the type in the same period."""
    active = _present(snap.where(F.col("age") < days), "dt", grain)
    ordered = _present(orders.where(F.col("order_type") == order_type), "start", grain)
    return (active.join(ordered, KEYS, "left_semi")
            .groupBy("period").agg(F.count("*").alias("accounts")))


def users_contact_and_order(snap: DataFrame, contacts: DataFrame, orders: DataFrame,
                            grain: str = "month") -> DataFrame:
    """Accounts with both a contact and an order in the period."""
    return (_present(snap, "dt", grain)
            .join(_present(contacts, "day", grain), KEYS, "left_semi")
            .join(_present(orders, "start", grain), KEYS, "left_semi")
            .groupBy("period").agg(F.count("*").alias("accounts")))


def caller_split(snap: DataFrame, contacts: DataFrame, purpose: str, days: int = 90,
                 grain: str = "month") -> DataFrame:
    """Active accounts per period with one and with several contacts of the purpose."""
    active = _present(snap.where((F.col("age") < days) | F.col("age").isNull()), "dt", grain)
    calls = (contacts.where(F.col("purpose") == purpose)
             .groupBy("account", period_of(F.col("day"), grain).alias("period"))
             .agg(F.count_distinct("interaction_id").alias("calls")))
    kind = F.when(F.col("calls") == 1, "Single caller").otherwise("Repeated caller")
    return (calls.join(active, KEYS, "left_semi").groupBy("period", kind.alias("caller"))
            .agg(F.count("*").alias("accounts")))


def order_near_contact(snap: DataFrame, contacts: DataFrame, orders: DataFrame, days: int = 40,
                       grain: str = "month") -> DataFrame:
    """How many active accounts contacted at most ``days`` days after an order of the period.

    A pair within the limit exists exactly when the earliest contact and the latest order
    are one, so both sides are reduced before the join and no pairs are formed.
    """
    first = contacts.groupBy("account", period_of(F.col("day"), grain).alias("period")).agg(
        F.min("day").alias("contact"))
    last = orders.groupBy("account", period_of(F.col("start"), grain).alias("period")).agg(
        F.max("start").alias("ordered"))
    near = first.join(last, KEYS).where(F.datediff("contact", "ordered") <= days)
    return (near.join(_present(snap, "dt", grain), KEYS, "left_semi")
            .agg(F.count_distinct("account").alias("accounts")))


def dashboard_counts(table: DataFrame, views: Sequence[tuple[str, Column, Sequence[str], str]],
                     dims: Sequence[str]) -> DataFrame:
    """All dashboard views as one long table: view, period, its dimensions, value.

    A view is (name, filter, dimensions, measure); the measure is ``users`` for account
    rows or ``rgus`` for RGUs lost. ``table`` has one row per period and final account, so
    rows are distinct accounts. It is reduced once to a cube over all dimensions and view
    filters; each cube row is then spread to the views it belongs to and summed there.
    """
    keeps = {f"_keep_{i}": F.coalesce(keep, F.lit(False)) for i, (_, keep, _, _) in enumerate(views)}
    cube = table.withColumns(keeps).groupBy("period", *dims, *keeps).agg(
        F.count("*").alias("users"),
        (F.sum("b_total_rgus") - F.sum(F.coalesce("e_total_rgus", F.lit(0.0)))).alias("rgus"))
    spread = F.array(*[
        F.struct(F.lit(name).alias("view"),
                 *[(F.col(d) if d in shown else F.lit(None)).cast("string").alias(d) for d in dims],
                 F.col(measure).cast("double").alias("value"), F.col(f"_keep_{i}").alias("_keep"))
        for i, (name, _, shown, measure) in enumerate(views)])
    return (cube.select("period", F.inline(spread)).where("_keep")
            .groupBy("view", "period", *dims).agg(F.round(F.sum("value"), 4).alias("value")))


def zero_p_recovered(table: DataFrame, daily: DataFrame, rejoiner_type: str, grain: str = "month") -> DataFrame:
    """Rejoiners of the type that hold RGUs again on some day of the period."""
    holding = _present(daily.where(F.col("num_rgus") > 0), "dt", grain)
    back = table.where(F.col("rejoiner_type") == rejoiner_type).select(*KEYS)
    return back.join(holding, KEYS, "left_semi").groupBy("period").agg(F.count("*").alias("accounts"))


def rgu_adjust_check(table: DataFrame, best: DataFrame, disconnects: DataFrame, churn_type: str,
                     grain: str = "month") -> DataFrame:
    """Churners whose best RGU count exceeds the opening one.

    Adds the movement of the period before and whether a disconnect order explains the
    loss in this or that period.
    """
    window = Window.partitionBy("account").orderBy("period")
    before = F.lag(F.struct("period", "main_movement")).over(window)
    rows = (table.withColumn("_p", before)
            .where(F.col("churn_type") == churn_type)
            .withColumn("previous_movement", F.when(
                shift_period(F.col("_p.period"), 1, grain) == F.col("period"), F.col("_p.main_movement")))
            .join(best.select(*KEYS, "max_rgus"), KEYS))
    explained = (disconnects.select("account", F.explode(F.array(
        F.col("period"), shift_period(F.col("period"), 1, grain))).alias("period"))
        .distinct().withColumn("_order", F.lit(1)))
    return (rows.where(F.col("max_rgus") > F.col("b_num_rgus")).join(explained, KEYS, "left")
            .select(*KEYS, "b_mix", "b_num_rgus", "max_rgus", "previous_movement",
                    F.coalesce("_order", F.lit(0)).alias("has_order")))


def unexplained(checked: DataFrame) -> DataFrame:
    """Checked accounts without a disconnect order."""
    return checked.where("has_order = 0")


def missing_from(sales: DataFrame, table: DataFrame) -> DataFrame:
    """Sales whose account is not in the table."""
    return sales.join(table.select("account").distinct(), "account", "left_anti")


def reconcile(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One row per account of two lists: in both or only in one."""
    a = left.select("account").distinct().withColumn("_a", F.lit(1))
    b = right.select("account").distinct().withColumn("_b", F.lit(1))
    return a.join(b, "account", "full").select("account", F.when(
        F.col("_a").isNotNull() & F.col("_b").isNotNull(), "both")
        .when(F.col("_a").isNotNull(), f"only {names[0]}").otherwise(f"only {names[1]}").alias("found"))


def changed_products_of(accounts: DataFrame, daily: DataFrame) -> DataFrame:
    """Accounts of a list with at least one product change between neighbouring days."""
    changes = product_changes_vs_previous(daily).where("changed").select("account").distinct()
    return accounts.select("account").join(changes, "account", "left_semi")


def mortality_vs_npn(panel: DataFrame, billed: DataFrame, payments: DataFrame, horizon: int, npn: str) -> DataFrame:
    """Payments of accounts that are gone at the horizon but were no never-paid accounts."""
    gone = panel.where(F.col(f"surv_{horizon}").isNull()).select("account").distinct()
    payers = billed.where(F.col(npn).isNull()).select("account", "max_mrc")
    paid = payments.groupBy("account").agg(
        F.round(F.sum(F.expr("try_cast(amount_text AS double)")), 2).alias("paid"))
    return payers.join(gone, "account", "left_semi").join(paid, "account")


def reconcile_gross_fmc(gross: DataFrame, table: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Accounts of the sales file against new accounts of the table, by dimensions.

    Both sides are distinct, so a group meets an account once and plain counts suffice.
    """
    sold = gross.select("account").distinct().withColumn("_g", F.lit(1))
    listed = table.select("account", *dims).distinct().withColumn("_t", F.lit(1))
    joined = sold.join(listed, "account", "full")
    only = lambda a, b: F.count(F.when(a & b, F.col("account")))
    g, t = F.col("_g").isNotNull(), F.col("_t").isNotNull()
    return joined.groupBy(*dims).agg(only(g, t).alias("both"), only(~g, t).alias("table_only"),
                                     only(g, ~t).alias("gross_only"))
