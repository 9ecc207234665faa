"""Operational drivers and contact drivers on the weekly account base, and their KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from abonara.functions.calendar import period_of, shift_period
from abonara.functions.rules import first_match
from abonara.operators import contact as I
from abonara.operators import kpi as J
from abonara.operators import sales as G
from abonara.operators.dedup import dedup_interactions
from abonara.plans.fixtures import Inputs

GRAIN = "week"
TECHNICAL, BILLING, EXCLUDED = ("error",), ("purchase",), ("view",)
#: The week in which the supplied events end.
AS_OF = "2024-01-29"
DRIVER_FLAGS = ["sales", "soft_dx", "long_install", "early_contact", "early_ticket", "bill_claim",
                "bill_shock", "no_plan_change", "mounting_bill"]
CONTACT_FLAGS = ["one_call", "two_calls", "more_calls", "one_ticket", "two_tickets", "more_tickets", "failed"]


def contacts(inputs: Inputs) -> DataFrame:
    return dedup_interactions(inputs.contacts)


def tickets(inputs: Inputs) -> DataFrame:
    return contacts(inputs).where(F.col("purpose").isin(*TECHNICAL) & I.not_annulled())


def billing_calls(inputs: Inputs) -> DataFrame:
    return contacts(inputs).where(F.col("purpose").isin(*BILLING) & I.not_annulled())


def care_contacts(inputs: Inputs) -> DataFrame:
    return contacts(inputs).where(~F.col("purpose").isin(*EXCLUDED) & I.not_annulled())


def sales(inputs: Inputs) -> DataFrame:
    return inputs.bills.groupBy("account").agg(F.min("dt").alias("sale_day"))


def base(inputs: Inputs, as_of: str = AS_OF) -> DataFrame:
    """Weekly account base with dimensions, RGUs, charge change, plans and churn flag.

    RGUs are the services that the account held in the week. From the week of ``as_of`` on
    nobody can be seen to leave, so no row of it is a churner.
    """
    weekly = inputs.usage.groupBy("account", period_of(F.col("dt"), GRAIN).alias("period")).agg(
        (F.max("rgu_bb") + F.max("rgu_tv") + F.max("rgu_vo")).alias("rgus"),
        F.max("mrc").alias("mrc"), F.max("age").alias("age"))
    by_week = Window.partitionBy("account").orderBy("period")
    before = F.lag(F.struct("period", "mrc", "age")).over(by_week)
    after = F.lead("period").over(by_week)
    last = F.col("period") >= F.to_date(F.lit(as_of))
    stays = last | (after == shift_period(F.col("period"), 1, GRAIN))
    rows = weekly.withColumns({"_p": before, "_stays": F.coalesce(stays, F.lit(False))})
    neighbour = shift_period(F.col("_p.period"), 1, GRAIN) == F.col("period")
    plan = lambda age: F.floor(age / 50).cast("string")
    return rows.join(inputs.dims.drop("nation_key"), "account").select(
        "account", F.col("account").alias("fixed_account"), "period", "segment", "province", "rgus",
        F.when(neighbour, F.col("_p.mrc")).alias("b_total_mrc"),
        F.when(neighbour, F.round(F.col("mrc") - F.col("_p.mrc"), 2)).alias("mrc_change"),
        F.when(neighbour, plan(F.col("_p.age"))).alias("b_plan"), plan(F.col("age")).alias("e_plan"),
        F.when(neighbour, plan(F.col("_p.age"))).alias("b_plan_full"), plan(F.col("age")).alias("e_plan_full"),
        F.when(F.col("_stays"), "Non Churner").otherwise("Fixed Churner").alias("final_churn_flag"))


def soft_disconnects(inputs: Inputs) -> DataFrame:
    cohort = G.densest_day_cohort(sales(inputs).withColumnRenamed("sale_day", "first_day"), GRAIN)
    ages = inputs.usage.withColumnRenamed("age", "age_fix")
    return G.soft_dx(ages, cohort).where(F.col("soft_dx").isNotNull())


def mounting(inputs: Inputs) -> DataFrame:
    return I.mounting_bill(inputs.usage, 60, GRAIN, age="age").where("mounting_bill = 1")


def driver_flags(inputs: Inputs) -> dict:
    sold = sales(inputs)
    return {
        "sales": sold.withColumn("period", period_of(F.col("sale_day"), GRAIN)),
        "soft_dx": soft_disconnects(inputs),
        "long_install": I.long_install(inputs.install_orders, 5, GRAIN),
        "early_contact": I.early_contact(sold, care_contacts(inputs), 3, GRAIN),
        "early_ticket": I.early_ticket(sold, tickets(inputs), 1, GRAIN),
        "bill_claim": I.bill_claims(contacts(inputs), BILLING, GRAIN),
        "mounting_bill": mounting(inputs),
    }


def driver_table(inputs: Inputs, as_of: str = AS_OF) -> DataFrame:
    """Account-week base with every driver flag, joined once."""
    return I.attach_flags(I.bill_shock(base(inputs, as_of)), driver_flags(inputs))


def contact_flags(inputs: Inputs) -> dict:
    deduped = contacts(inputs)
    callers = I.repeat_callers(deduped, 7, EXCLUDED, GRAIN)
    tiers = I.ticket_tiers(tickets(inputs), 7, GRAIN)
    calls, ticketed = ("one_call", "two_calls", "more_calls"), {"1": "one_ticket", "2": "two_tickets", "3+": "more_tickets"}
    return {
        calls: callers.withColumn("mark", first_match([(F.col(n).isNotNull(), n) for n in calls])),
        tuple(ticketed.values()): tiers.withColumn("mark", first_match([(F.col("tier") == t, n) for t, n in ticketed.items()])),
        "failed": I.failed_visits(deduped, GRAIN),
    }


def contact_table(inputs: Inputs, as_of: str = AS_OF) -> DataFrame:
    """Account-week base with every contact flag and the ticket count."""
    density = I.ticket_density(contacts(inputs), TECHNICAL, GRAIN)
    return I.attach_flags(base(inputs, as_of), contact_flags(inputs)).join(density, ["account", "period"], "left")


def week_summary(inputs: Inputs, dims=("period", "segment")) -> DataFrame:
    """Driver and contact summary in one: base, flags and dimensions are computed once.

    Periods in which every account churned stay, with an ``active_base`` of 0.
    """
    flagged = I.attach_flags(I.bill_shock(base(inputs)), driver_flags(inputs) | contact_flags(inputs))
    table = flagged.join(I.ticket_density(contacts(inputs), TECHNICAL, GRAIN), ["account", "period"], "left")
    stays = ~F.col("final_churn_flag").isin(*I.CHURN_LABELS)
    names = DRIVER_FLAGS + CONTACT_FLAGS
    kept = table.withColumns({n: F.when(stays, F.col(n)) for n in ["account", "tickets", *names]})
    return I.driver_summary(kept, list(dims), names, ["tickets"])


def driver_summary(inputs: Inputs, dims=("period", "segment")) -> DataFrame:
    return I.driver_summary(I.without_churners(driver_table(inputs)), list(dims), DRIVER_FLAGS)


def contact_summary(inputs: Inputs, dims=("period", "segment")) -> DataFrame:
    return I.contact_summary(contact_table(inputs), list(dims), CONTACT_FLAGS, ["tickets"])


def call_counts(inputs: Inputs) -> DataFrame:
    counted = I.not_annulled()
    return I.contact_counts(contacts(inputs), {
        "tech_calls": F.col("purpose").isin(*TECHNICAL) & counted,
        "care_calls": ~F.col("purpose").isin(*EXCLUDED) & counted,
        "claims": F.col("purpose").isin(*BILLING) & counted,
    }, GRAIN)


def calls_per_1k(inputs: Inputs) -> DataFrame:
    return I.calls_per_1k(base(inputs), call_counts(inputs), ["tech_calls", "care_calls"])


def calls_per_variation(inputs: Inputs) -> DataFrame:
    return I.calls_per_variation(I.bill_shock(base(inputs)), call_counts(inputs))


def ftr(inputs: Inputs) -> DataFrame:
    return I.ftr_billing(billing_calls(inputs), 3, GRAIN)


def weekly_delivery(inputs: Inputs) -> DataFrame:
    """Service-delivery figures per week and network, from the order book."""
    key = F.col("o_orderkey")
    return inputs.table("orders").groupBy(
        period_of(F.to_date("o_orderdate"), "week").alias("end_week"),
        F.col("o_orderpriority").alias("network")).agg(
        F.count("*").alias("installs"), F.max(key % 48).alias("mtti"),
        F.count(F.when(F.col("o_orderstatus") == "P", 1)).alias("repairs"), F.max(key % 24).alias("mttr"),
        F.max(key % 10).alias("scr"), F.max(key % 30).alias("bad_install"), F.max(key % 20).alias("bad_repair"),
    ).withColumn("market", F.lit("all"))


def delivery(inputs: Inputs) -> DataFrame:
    return J.service_delivery(weekly_delivery(inputs), "all", "3-MEDIUM")


def long_kpis(inputs: Inputs) -> DataFrame:
    """Measured and placeholder KPI rows of all parts."""
    measured = week_summary(inputs).groupBy("period").agg(*J.driver_measures(), *J.contact_measures())
    return J.combine_kpis([
        J.to_long(measured, J.MEASURED + J.CONTACT, empty=J.PLACEHOLDERS), J.to_long(delivery(inputs), J.DELIVERY)])
