"""The KPI layer: ratios, the long table and its overall view."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from abonara.functions.calendar import period_of


class Kpi(NamedTuple):
    """One KPI of the long table; columns may be None for a placeholder."""

    facet: str
    waypoint: str
    name: str
    meas: str | None = None
    num: str | None = None
    den: str | None = None
    delay: str = "M-0"


# KPIs that other systems fill; only their empty rows are written here.
PLACEHOLDERS = (
    Kpi("digital_shift", "buy", "%eCommerce"),
    Kpi("NPS_Detractorship", "buy", "tBuy"),
    Kpi("customer_time", "buy", "MTTB"),
    Kpi("contact_intensity", "buy", "Buying_Calls/GA"),
    Kpi("NPS_Detractorship", "get", "tInstall"),
    Kpi("digital_shift", "get", "%self_installs"),
    Kpi("contact_intensity", "get", "Install_Calls/Installs"),
    Kpi("customer_time", "pay", "MTTBTR"),
    Kpi("NPS_Detractorship", "pay", "tpay"),
    Kpi("NPS_Detractorship", "support-call", "tHelp_Care"),
    Kpi("effectiveness", "support-call", "%FRC_Care"),
    Kpi("NPS_Detractorship", "support-tech", "tHelp_repair"),
    Kpi("high_risk", "use", "%_High_Tech_Call_Nodes_+6%monthly"),
    Kpi("NPS_Detractorship", "use", "pNPS"),
    Kpi("customer_time", "support-call", "%CC_SL_Care"),
    Kpi("customer_time", "support-call", "%CC_SL_Tech"),
    Kpi("digital_shift", "support-call", "%Chatbot_containment_care"),
    Kpi("digital_shift", "support-tech", "%Chatbot_containment_Tech"),
    Kpi("digital_shift", "pay", "%digital_payments"),
)

# Measured KPIs of the dashboard.
MEASURED = (
    Kpi("contact_drivers", "buy", "Gross_Adds", "sales"),
    Kpi("contact_drivers", "use", "Active_Base", "active_base"),
    Kpi("contact_drivers", "support-call", "Active_Base", "active_base"),
    Kpi("contact_drivers", "pay", "%Customers_w_MRC_Changes_5%+_excl_plan", "mrc_change_share",
        "bill_shock", "no_plan_change"),
    Kpi("high_risk", "buy", "%New_Sales_to_Soft_Dx", "soft_dx_share", "soft_dx", "sales", "M-1"),
    Kpi("high_risk", "buy", "%New_Customer_Callers_2+calls_21days", "early_contact_share",
        "early_contact", "sales", "M-1"),
    Kpi("high_risk", "get", "%breech_cases_install_6+days", "long_install_share", "long_install",
        "sales", "M-1"),
    Kpi("high_risk", "get", "%Early_Tech_Tix_-7weeks", "early_ticket_share", "early_ticket",
        "sales", "M-2"),
    Kpi("high_risk", "pay", "%Customers_w_Mounting_Bills", "mounting_bill"),
)
CONTACT = (
    Kpi("contact_intensity", "use", "Tech_Tix_per_100_Acct", "tickets_per_account", "tickets", "active_base"),
    Kpi("high_risk", "support-call", "%Repeat_Callers_2+calls", "repeat_share", "repeat_callers",
        "active_base", "M-2"),
)
DELIVERY = (
    Kpi("contact_drivers", "get", "Installs", "installs"),
    Kpi("customer_time", "get", "MTTI", "mtti"),
    Kpi("effectiveness", "get", "%FTR_installs", "ftr_install"),
    Kpi("contact_drivers", "support-tech", "Repairs", "repairs"),
    Kpi("customer_time", "support-tech", "MTTR", "mttr"),
    Kpi("effectiveness", "support-tech", "%FTR_Repair", "ftr_repair"),
    Kpi("contact_intensity", "support-tech", "Repairs_per_1k_rgu", "repairs_1k"),
)


def share(part: str, whole: str, digits: int = 4) -> Column:
    """Rounded ratio; null when the whole is zero or null."""
    return F.round(F.try_divide(F.sum(part), F.sum(whole)), digits)


def driver_measures() -> list[Column]:
    totals = ["active_base", "sales", "soft_dx", "long_install", "early_contact", "early_ticket",
              "bill_claim", "bill_shock", "no_plan_change", "mounting_bill"]
    return [
        *[F.sum(t).alias(t) for t in totals],
        share("bill_shock", "no_plan_change").alias("mrc_change_share"),
        *[share(t, "sales").alias(f"{t}_share")
          for t in ("soft_dx", "long_install", "early_contact", "early_ticket")]]


def contact_measures() -> list[Column]:
    repeat = F.sum(F.col("two_calls") + F.col("more_calls"))
    return [
        repeat.alias("repeat_callers"), F.sum("tickets").alias("tickets"),
        F.round(F.try_divide(repeat, F.sum("active_base")), 4).alias("repeat_share"),
        share("tickets", "active_base").alias("tickets_per_account")]


def driver_kpis(summary: DataFrame) -> DataFrame:
    """Driver totals per period and their ratios to sales and to the unchanged base."""
    return summary.groupBy("period").agg(*driver_measures())


def contact_kpis(summary: DataFrame) -> DataFrame:
    """Repeat callers and tickets per account and period."""
    return summary.groupBy("period").agg(F.sum("active_base").alias("active_base"), *contact_measures())


def additional_kpis(tables: Iterable[DataFrame]) -> DataFrame:
    """Roll the per-period call measures up into one row per period."""
    joined = reduce(lambda a, b: a.join(b, "period", "full"), tables)
    return joined.groupBy("period").agg(*[F.sum(c).alias(c) for c in joined.columns if c != "period"])


def service_delivery(weekly: DataFrame, market: str, network: str) -> DataFrame:
    """Monthly volume-weighted installation and repair times and first-time-right shares."""
    rows = weekly.where((F.col("market") == market) & (F.col("network") == network))
    week = rows.groupBy(period_of(F.col("end_week"), "month").alias("period"), "end_week").agg(
        F.sum("installs").alias("installs"), F.sum("mtti").alias("mtti"),
        F.sum("repairs").alias("repairs"), F.sum("mttr").alias("mttr"), F.sum("scr").alias("scr"),
        (100 - F.sum("bad_install")).alias("ftr_install"), (100 - F.sum("bad_repair")).alias("ftr_repair"))
    weighted = lambda value, by: F.try_divide(F.sum(F.col(value) * F.col(by)), F.sum(by))
    return week.groupBy("period").agg(
        F.sum("installs").alias("installs"), F.round(weighted("mtti", "installs"), 2).alias("mtti"),
        F.sum("repairs").alias("repairs"), F.round(weighted("mttr", "repairs"), 2).alias("mttr"),
        F.round(F.sum("scr"), 2).alias("repairs_1k"),
        F.round(weighted("ftr_install", "installs") / 100, 4).alias("ftr_install"),
        F.round(weighted("ftr_repair", "repairs") / 100, 4).alias("ftr_repair"))


LONG = ["period", "market", "facet", "waypoint", "kpi_name", "kpi_meas", "kpi_num", "kpi_den", "delay"]


def to_long(wide: DataFrame, specs: Sequence[Kpi], market: str = "all", empty: Sequence[Kpi] = ()) -> DataFrame:
    """Wide measures to long KPI rows, one per period and spec, in a single pass.

    With ``empty``, periods without an active base get only these specs, other periods both.
    """
    number = lambda c: (F.col(c) if c else F.lit(None)).cast("double")
    rows = lambda chosen: F.array(*[F.struct(
        F.lit(s.facet).alias("facet"), F.lit(s.waypoint).alias("waypoint"), F.lit(s.name).alias("kpi_name"),
        number(s.meas).alias("kpi_meas"), number(s.num).alias("kpi_num"), number(s.den).alias("kpi_den"),
        F.lit(s.delay).alias("delay")) for s in chosen])
    shown = rows([*specs, *empty])
    if empty:
        shown = F.when(F.col("active_base") > 0, shown).otherwise(rows(empty))
    return wide.select("period", F.lit(market).alias("market"), F.inline(shown))


def placeholder_kpis(periods: DataFrame, specs: Sequence[Kpi] = PLACEHOLDERS, market: str = "all") -> DataFrame:
    """Empty KPI rows for every period."""
    return to_long(periods.select("period").distinct(), specs, market)


def combine_kpis(tables: Iterable[DataFrame]) -> DataFrame:
    """All KPI rows, each once."""
    return reduce(lambda a, b: a.unionByName(b), tables).distinct()


def overall_kpis(long: DataFrame) -> DataFrame:
    """Overall value per KPI: ratio of sums where both parts exist, else the summed value.

    A KPI with only one part has no value.
    """
    dims = ["period", "market", "waypoint", "facet", "kpi_name"]
    has = lambda c: F.col(c).isNotNull()
    kind = F.when(has("kpi_num") & has("kpi_den"), "ratio").when(
        ~has("kpi_num") & ~has("kpi_den"), "sum").otherwise("none")
    grouped = long.withColumn("_kind", kind).groupBy(*dims, "_kind").agg(
        F.sum("kpi_meas").alias("meas"), F.sum("kpi_num").alias("num"), F.sum("kpi_den").alias("den"))
    return grouped.select(
        *dims,
        F.when(F.col("_kind") == "sum", F.col("meas")).when(
            F.col("_kind") == "ratio", F.try_divide("num", "den")).alias("kpi_meas"),
        F.coalesce("num", F.lit(0.0)).alias("kpi_num"), F.coalesce("den", F.lit(0.0)).alias("kpi_den"),
        F.lit("Overall").alias("network"),
        F.year("period").alias("ref_year"), F.month("period").alias("ref_month"))


def digital_share(payments: DataFrame, grain: str = "month") -> DataFrame:
    """Percent of payments made digitally per period (payment ids are unique)."""
    digital = F.count(F.when(F.col("channel_kind") == "Digital", 1))
    return payments.groupBy(period_of(F.col("dt"), grain).alias("period")).agg(
        F.count("*").alias("payments"), digital.alias("digital"),
        F.round(F.try_divide(digital, F.count("*")) * 100, 2).alias("digital_share"))
