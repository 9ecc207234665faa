"""KPI layer."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth
from abonara.catalog.contact import wk
from abonara.catalog.registry import case, fragment
from abonara.operators import kpi as J
from abonara.plans import drivers as P

_totals = ["active_base", "sales", "soft_dx", "long_install", "early_contact", "early_ticket",
           "bill_claim", "bill_shock", "no_plan_change", "mounting_bill"]


def _share(a, b, digits=4):
    return f"round(sum({a}) / nullif(sum({b}), 0), {digits})"


fragment("driver_kpis", "driver_summary", "SELECT period, " + ", ".join(
    f"CAST(sum({t}) AS BIGINT) AS {t}" for t in _totals) + f""",
    {_share('bill_shock', 'no_plan_change')} AS mrc_change_share,
    {_share('soft_dx', 'sales')} AS soft_dx_share, {_share('long_install', 'sales')} AS long_install_share,
    {_share('early_contact', 'sales')} AS early_contact_share, {_share('early_ticket', 'sales')} AS early_ticket_share
  FROM driver_summary GROUP BY period""")


@case("driver_kpis", "J1", "driver_kpis", "SELECT * FROM driver_kpis")
def _(inputs):
    return J.driver_kpis(P.driver_summary(inputs))


fragment("contact_kpis", "contact_summary", """
  SELECT period, CAST(sum(active_base) AS BIGINT) AS active_base,
    CAST(sum(two_calls + more_calls) AS BIGINT) AS repeat_callers, CAST(sum(tickets) AS BIGINT) AS tickets,
    round(sum(two_calls + more_calls) / sum(active_base), 4) AS repeat_share,
    round(sum(tickets) / sum(active_base), 4) AS tickets_per_account
  FROM contact_summary GROUP BY period""")


@case("contact_kpis", "J2", "contact_kpis", "SELECT * FROM contact_kpis")
def _(inputs):
    return J.contact_kpis(P.contact_summary(inputs))


@case("additional_kpis", "J3", "per_1k per_variation ftr", """
  SELECT period, a.rgus, tech_calls, care_calls, tech_calls_per_1k, care_calls_per_1k, variations,
    b.billing_calls, calls_per_variation, resolved, c.billing_calls AS all_billing_calls, ftr
  FROM per_1k a FULL JOIN per_variation b USING (period) FULL JOIN ftr c USING (period)""")
def _(inputs):
    ftr = P.ftr(inputs).withColumnRenamed("billing_calls", "all_billing_calls")
    return J.additional_kpis([P.calls_per_1k(inputs), P.calls_per_variation(inputs), ftr])


fragment("delivery", "", f"""
  SELECT period, CAST(sum(installs) AS BIGINT) AS installs, round(sum(mtti * installs) / sum(installs), 2) AS mtti,
    CAST(sum(repairs) AS BIGINT) AS repairs, round(sum(mttr * repairs) / nullif(sum(repairs), 0), 2) AS mttr,
    CAST(sum(scr) AS BIGINT) AS repairs_1k,
    round(sum((100 - bad_install) * installs) / sum(installs) / 100, 4) AS ftr_install,
    round(sum((100 - bad_repair) * repairs) / nullif(sum(repairs), 0) / 100, 4) AS ftr_repair
  FROM (SELECT {mth(wk('o_orderdate'))} AS period, {wk('o_orderdate')} AS end_week, count(*) AS installs,
      max(o_orderkey % 48) AS mtti, count(*) FILTER (WHERE o_orderstatus = 'P') AS repairs,
      max(o_orderkey % 24) AS mttr, max(o_orderkey % 10) AS scr, max(o_orderkey % 30) AS bad_install,
      max(o_orderkey % 20) AS bad_repair
    FROM orders WHERE o_orderpriority = '3-MEDIUM' GROUP BY 1, 2) w GROUP BY period""")


@case("service_delivery", "J4", "delivery", "SELECT * FROM delivery")
def _(inputs):
    return P.delivery(inputs)


def _row(table, facet, waypoint, name, meas, num="NULL", den="NULL", delay="M-0"):
    d = lambda c: f"CAST({c} AS DOUBLE)"
    return (f"SELECT period, 'all' AS market, '{facet}' AS facet, '{waypoint}' AS waypoint, '{name}' AS kpi_name, "
            f"{d(meas)} AS kpi_meas, {d(num)} AS kpi_num, {d(den)} AS kpi_den, '{delay}' AS delay FROM {table}")


fragment("long_drivers", "driver_kpis", " UNION ALL ".join([
    _row("driver_kpis", "contact_drivers", "buy", "Gross_Adds", "sales"),
    _row("driver_kpis", "contact_drivers", "use", "Active_Base", "active_base"),
    _row("driver_kpis", "contact_drivers", "support-call", "Active_Base", "active_base"),
    _row("driver_kpis", "contact_drivers", "pay", "%Customers_w_MRC_Changes_5%+_excl_plan", "mrc_change_share",
         "bill_shock", "no_plan_change"),
    _row("driver_kpis", "high_risk", "buy", "%New_Sales_to_Soft_Dx", "soft_dx_share", "soft_dx", "sales", "M-1"),
    _row("driver_kpis", "high_risk", "buy", "%New_Customer_Callers_2+calls_21days", "early_contact_share",
         "early_contact", "sales", "M-1"),
    _row("driver_kpis", "high_risk", "get", "%breech_cases_install_6+days", "long_install_share",
         "long_install", "sales", "M-1"),
    _row("driver_kpis", "high_risk", "get", "%Early_Tech_Tix_-7weeks", "early_ticket_share",
         "early_ticket", "sales", "M-2"),
    _row("driver_kpis", "high_risk", "pay", "%Customers_w_Mounting_Bills", "mounting_bill"),
]))


@case("long_driver_kpis", "J5", "long_drivers", "SELECT * FROM long_drivers")
def _(inputs):
    return J.to_long(J.driver_kpis(P.driver_summary(inputs)), J.MEASURED)


_empty = [("digital_shift", "buy", "%eCommerce"), ("NPS_Detractorship", "buy", "tBuy"),
          ("customer_time", "buy", "MTTB"), ("contact_intensity", "buy", "Buying_Calls/GA"),
          ("NPS_Detractorship", "get", "tInstall"), ("digital_shift", "get", "%self_installs"),
          ("contact_intensity", "get", "Install_Calls/Installs"), ("customer_time", "pay", "MTTBTR"),
          ("NPS_Detractorship", "pay", "tpay"), ("NPS_Detractorship", "support-call", "tHelp_Care"),
          ("effectiveness", "support-call", "%FRC_Care"), ("NPS_Detractorship", "support-tech", "tHelp_repair"),
          ("high_risk", "use", "%_High_Tech_Call_Nodes_+6%monthly"), ("NPS_Detractorship", "use", "pNPS"),
          ("customer_time", "support-call", "%CC_SL_Care"), ("customer_time", "support-call", "%CC_SL_Tech"),
          ("digital_shift", "support-call", "%Chatbot_containment_care"),
          ("digital_shift", "support-tech", "%Chatbot_containment_Tech"),
          ("digital_shift", "pay", "%digital_payments")]
fragment("periods", "week_base", "SELECT DISTINCT period FROM week_base")
fragment("placeholders", "periods", " UNION ALL ".join(_row("periods", *e, "NULL") for e in _empty))


@case("placeholder_kpis", "J6", "placeholders", "SELECT * FROM placeholders")
def _(inputs):
    return J.placeholder_kpis(P.base(inputs))


fragment("all_kpis", "long_drivers contact_kpis delivery placeholders",
         "SELECT DISTINCT * FROM (SELECT * FROM long_drivers UNION ALL SELECT * FROM placeholders UNION ALL "
         + " UNION ALL ".join([
             _row("contact_kpis", "contact_intensity", "use", "Tech_Tix_per_100_Acct", "tickets_per_account",
                  "tickets", "active_base"),
             _row("contact_kpis", "high_risk", "support-call", "%Repeat_Callers_2+calls", "repeat_share",
                  "repeat_callers", "active_base", "M-2"),
             _row("delivery", "contact_drivers", "get", "Installs", "installs"),
             _row("delivery", "customer_time", "get", "MTTI", "mtti"),
             _row("delivery", "effectiveness", "get", "%FTR_installs", "ftr_install"),
             _row("delivery", "contact_drivers", "support-tech", "Repairs", "repairs"),
             _row("delivery", "customer_time", "support-tech", "MTTR", "mttr"),
             _row("delivery", "effectiveness", "support-tech", "%FTR_Repair", "ftr_repair"),
             _row("delivery", "contact_intensity", "support-tech", "Repairs_per_1k_rgu", "repairs_1k"),
         ]) + ") k")


@case("all_kpis", "J5 J6 J7", "all_kpis", "SELECT * FROM all_kpis")
def _(inputs):
    return P.long_kpis(inputs)


@case("overall_kpis", "J8", "all_kpis", """
  SELECT period, market, waypoint, facet, kpi_name,
    CASE WHEN kind = 0 THEN sum(kpi_meas) WHEN kind = 2 THEN sum(kpi_num) / nullif(sum(kpi_den), 0) END AS kpi_meas,
    coalesce(sum(kpi_num), 0) AS kpi_num, coalesce(sum(kpi_den), 0) AS kpi_den, 'Overall' AS network,
    CAST(year(period) AS INTEGER) AS ref_year, CAST(month(period) AS INTEGER) AS ref_month
  FROM (SELECT *, CAST(kpi_num IS NOT NULL AS INTEGER) + CAST(kpi_den IS NOT NULL AS INTEGER) AS kind
        FROM all_kpis) k
  GROUP BY period, market, waypoint, facet, kpi_name, kind""")
def _(inputs):
    return J.overall_kpis(P.long_kpis(inputs))


@case("digital_payment_share", "J9", "", f"""
  SELECT {wk('ts')} AS period, count(DISTINCT event_id) AS payments,
    count(DISTINCT event_id) FILTER (WHERE value >= 50) AS digital,
    round(count(DISTINCT event_id) FILTER (WHERE value >= 50) / count(DISTINCT event_id) * 100, 2) AS digital_share
  FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def _(inputs):
    kind = F.when(F.expr("try_cast(amount_text AS double)") >= 50, "Digital").otherwise("Counter")
    return J.digital_share(inputs.payments.withColumn("channel_kind", kind), "week")
