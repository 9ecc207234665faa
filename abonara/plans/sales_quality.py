"""Sales quality: sales and upsells with their bills and payments, then cohorts.

The sales part runs on the event family with day windows, the cohort part on the order
family by quarter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abonara.functions.profile import flag, overdue_age
from abonara.operators import billing as B
from abonara.operators import cohort as H
from abonara.operators import history as A
from abonara.operators import sales as G
from abonara.operators import timeline as L
from abonara.plans.fixtures import Inputs
from abonara.plans.tables import repaired

HORIZONS = {"7": B.days(7), "14": B.days(14), "21": B.days(21)}
LOOK_BACK = 5
RUN_WEEK = "2024-01-08"
AS_OF = "2024-01-25"
COHORT_AS_OF = "2001-07-01"
PERIODS = 12


def day(text: str):
    return F.to_date(F.lit(text))


# -- sales -----------------------------------------------------------------------------

def cycle(inputs: Inputs) -> DataFrame:
    bills = B.first_bill(inputs.bills)
    mrc = B.max_mrc_window(inputs.bills, bills, B.days(8))
    return B.first_cycle(inputs.bills, mrc, day(AS_OF))


def paid(inputs: Inputs, facts: DataFrame, look_back: int = LOOK_BACK) -> DataFrame:
    return B.payment_windows(inputs.payments, facts, HORIZONS, look_back, B.days(22))


def stream(inputs: Inputs) -> DataFrame:
    """Charges and payments of every account by day."""
    return L.day_rows(inputs.bills, inputs.payments)


def flagged(inputs: Inputs, facts: DataFrame) -> DataFrame:
    """Never-paid flags and the first sufficient payment of billing facts."""
    covered = facts.join(L.first_sufficient(inputs.payments, facts), "account", "left")
    return B.npn_columns(covered, list(HORIZONS), never=22)


def never_paid(inputs: Inputs) -> DataFrame:
    """Every account with its first cycle, payments and never-paid flags."""
    facts = L.billing_facts(stream(inputs), HORIZONS, B.days(8), LOOK_BACK, B.days(22))
    since = F.datediff(day(AS_OF), F.col("first_bill"))
    return flagged(inputs, facts.withColumn("days_since_bill", since))


def billed_sales(inputs: Inputs) -> DataFrame:
    return B.window_complete(never_paid(inputs), day(AS_OF), [7, 14, 21])


def newcomers(inputs: Inputs) -> DataFrame:
    return G.new_by_first_seen(inputs.bills, day(RUN_WEEK), back=3, ahead=3, grain="week")


def week_accounts(inputs: Inputs) -> DataFrame:
    """Gross adds and upsell candidates of the run week."""
    return G.newcomers_and_upsells(inputs.bills, day(RUN_WEEK), back=3, ahead=3, grain="week")


def upsells(inputs: Inputs) -> DataFrame:
    return week_accounts(inputs).where("base = 'Upsell'").drop("base")


def billed(inputs: Inputs, accounts: DataFrame) -> DataFrame:
    """Billing facts of gross adds from the first bill on, and of upsells from the change on.

    Only the wanted accounts are taken from the stream of charges and payments.
    """
    rows = stream(inputs).join(accounts, "account")
    gross = F.col("reached_on").isNull()
    carried = [c for c in accounts.columns if c != "account"]
    return L.billing_facts(rows, HORIZONS, B.days(8), F.when(gross, LOOK_BACK).otherwise(0), B.days(22),
                           F.col("reached_on"), carried)


def billed_upsells(inputs: Inputs) -> DataFrame:
    """Upsell candidates with first bill, charge and payments from the change on."""
    return flagged(inputs, billed(inputs, upsells(inputs))).drop("max_rgus", "first_day")


def merged_sales(inputs: Inputs) -> DataFrame:
    """Gross adds and upsells of the run week in one layout, with sale attributes and labels."""
    facts = billed(inputs, week_accounts(inputs))
    sold = B.npn_columns(facts, list(HORIZONS), never=22).withColumn(
        "max_rgus", F.when(F.col("base") == "Gross-add", F.col("max_rgus"))).select(
        "account", "base", "first_bill", "max_mrc", "paid_total", "npn_7", "npn_14", "npn_21", "npn", "max_rgus",
        "first_mix_qty", "last_mix_qty", "upsell_kind", "upsell_rgus", "upsell_named_rgus")
    return G.sales_flags(sold.join(G.first_sale_attrs(inputs.gross_adds), "account"))


# -- cohorts ---------------------------------------------------------------------------

def cohort_rows(inputs: Inputs) -> DataFrame:
    """Daily rows whose bill is the one that is unpaid on that day."""
    return inputs.snap.withColumn(
        "bill_dt", F.when(F.col("age").isNotNull(), F.date_sub("unpaid_dt", 1)))


def cohort_sales(inputs: Inputs) -> DataFrame:
    """Each account's first quarter, the RGUs sold in it and a sales dimension."""
    return inputs.closing.groupBy("account").agg(
        F.min("period").alias("sale_period"), F.min_by("num_rgus", "period").alias("rgus_sold"),
        F.min_by("priority", "period").alias("movement"))


def followed(inputs: Inputs) -> DataFrame:
    """Every account with its live closing rows of the periods after its first."""
    closing = inputs.closing.withColumnsRenamed({"bill_amt": "mrc", "num_rgus": "rgus", "priority": "movement"})
    return A.follow(closing, ["age", "unpaid_dt", "mrc", "rgus", "movement"], F.col("mix") != "0P", PERIODS, "quarter")


def survived(inputs: Inputs) -> DataFrame:
    panel = A.survival(followed(inputs), "quarter", 90, gap_periods=("1998-10-01",))
    return A.losses(panel, day(COHORT_AS_OF), "quarter")


PANEL = {"surv": "surv", "age": "age", "churn": "churn", "churn_type": "churn_type"}


def panel(inputs: Inputs) -> DataFrame:
    return A.wide(survived(inputs), ["account", "sale_period", "max_unpaid_dt"], PANEL, PERIODS)


def mortality(inputs: Inputs) -> DataFrame:
    """Sold accounts with their panel and whether they are gone at the sixth period.

    Cohorts without data at the end never count as gone.
    """
    incomplete = F.col("sale_period") == day("2001-04-01")
    rows = survived(inputs).withColumns({
        "rgus_sold": F.col("first.rgus"), "movement": F.col("first.movement"),
        "churned": flag(F.get("surv", F.lit(6)).isNull() & ~incomplete)})
    return A.wide(rows, ["account", "sale_period", "rgus_sold", "movement", "max_unpaid_dt", "churned"], PANEL, PERIODS)


def cohort_flags(inputs: Inputs) -> DataFrame:
    rows = cohort_rows(inputs)
    overdue = H.nth_bill_overdue(rows, H.first_n_bills(rows, 3, "quarter"), 3)
    return H.bill_cohort_flags(mortality(inputs), overdue, 3)


def arpu(inputs: Inputs) -> DataFrame:
    """Charge and RGUs of each account per period after the first."""
    rows = followed(inputs).where(A.seen())
    of = lambda name: F.transform("slots", lambda s: s[name])
    return A.wide(rows, ["account", "sale_period"], {"mrc": of("mrc"), "rgus": of("rgus")}, PERIODS)


def with_overdue(inputs: Inputs) -> DataFrame:
    return inputs.snap.withColumn("overdue", overdue_age(
        F.col("age"), [(F.col("bill_dt"), F.col("due_dt"))]))


def billed_ages(inputs: Inputs) -> DataFrame:
    return repaired(inputs).withColumn("start_dt", F.col("dt"))
