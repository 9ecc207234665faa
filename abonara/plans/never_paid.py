"""Gross adds of a run week with their sale and first cycle, and the driver cube by payment window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from abonara.functions.calendar import in_period
from abonara.functions.profile import channel_group, collapse_channel
from abonara.operators import billing as B
from abonara.operators import cohort as H
from abonara.operators import contact as I
from abonara.operators import sales as G
from abonara.operators.dedup import first_by
from abonara.plans import drivers as D
from abonara.plans import sales_quality as Q
from abonara.plans.fixtures import Inputs
from abonara.sources.commits import PeriodStore

WINDOWS = (7, 14, 21)
SALE_FLAGS = ["sold", *[f"npn_{n}" for n in WINDOWS], "npn"]
CUBE_FLAGS = ["in_base", *SALE_FLAGS, "long_install", "early_contact", "early_ticket", "bill_claim", "no_plan_change",
              "bill_shock", "mounting_bill"]
CUBE_DIMS = ["period", "segment", *[f"window_{n}" for n in WINDOWS], "sales_channel", "order_channel"]


def first_cycle_info(inputs: Inputs) -> DataFrame:
    """Gross adds of the run week: sale channel and RGUs sold, first installation, first bill and charge.

    Channels of door-to-door and digital sellers are folded. The installation is the first one
    completed on or after the account was first seen. An account without a first bill has no cycle.
    """
    new = Q.newcomers(inputs).select("account", F.col("first_day").alias("first_seen"))
    sold = G.first_sale_attrs(inputs.gross_adds).select(
        "account", collapse_channel(F.col("channel")).alias("sales_channel"), "sold_rgus")
    base = sold.join(new, "account")
    installed = G.first_install(inputs.install_orders.withColumnRenamed("completed", "inst_dt"),
                                new.withColumnRenamed("first_seen", "first_day"))
    facts = Q.never_paid(inputs).join(base, "account")
    return B.window_complete(facts, Q.day(Q.AS_OF), list(WINDOWS)).join(installed, "account", "left")


def order_channels(inputs: Inputs) -> DataFrame:
    """Sales-channel group of each account's first installation order, for orders completed in the run week."""
    week = inputs.install_orders.where(in_period(F.col("completed"), Q.day(Q.RUN_WEEK), D.GRAIN))
    first = first_by(week, ["account"], ["start", "order_id"], {"order_channel": channel_group(F.col("channel"))})
    return first.withColumn("period", Q.day(Q.RUN_WEEK))


def never_paid_rows(inputs: Inputs) -> DataFrame:
    """Account-week base with driver flags, beside the gross adds of the run week.

    A sold account that is not in the base of the week has a row of its own. Both tables have one
    row per account and week.
    """
    sold = first_cycle_info(inputs).select(
        "account", F.col("account").alias("sold"), *SALE_FLAGS[1:], "sales_channel", *[f"window_{n}" for n in WINDOWS],
    ).withColumn("period", Q.day(Q.RUN_WEEK))
    base = D.driver_table(inputs).withColumn("in_base", F.col("account"))
    return (base.join(sold, ["account", "period"], "full")
            .join(order_channels(inputs), ["account", "period"], "left"))


def never_paid_cube(inputs: Inputs) -> DataFrame:
    """Distinct accounts per flag by week, segment, window labels and both channels."""
    return I.driver_summary(never_paid_rows(inputs), CUBE_DIMS, CUBE_FLAGS).drop("active_base")


# -- saved sales-quality periods --------------------------------------------------------------


def save_sales_quality(inputs: Inputs, store: PeriodStore) -> list[date]:
    """Part one, the sales of each period, then part two, their bills and churn, built on the saved part one."""
    sales = Q.cohort_sales(inputs).withColumnRenamed("sale_period", "period")
    periods = store.save_all("sales", sales)
    saved = store.read("sales").withColumnRenamed("period", "sale_period")
    flags = Q.cohort_flags(inputs).drop("rgus_sold", "movement").join(saved, ["account", "sale_period"])
    return store.save_all("sales_quality", flags.withColumnRenamed("sale_period", "period"), [("sales", p) for p in periods])


def sales_quality_rollup(store: PeriodStore) -> DataFrame:
    """All saved periods stacked and rolled up by sale period and movement."""
    stacked = store.read("sales_quality").withColumnRenamed("period", "sale_period")
    return H.cohort_rollup(stacked, ["sale_period", "movement"], 3)
