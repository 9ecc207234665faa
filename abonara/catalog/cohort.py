"""Cohorts after the sale."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import q
from abonara.catalog.registry import case, fragment
from abonara.operators import cohort as H
from abonara.plans import sales_quality as P

N = range(13)

fragment("cohort_sales", "closing", """
  SELECT account, min(period) AS sale_period, arg_min(num_rgus, period) AS rgus_sold,
    arg_min(priority, period) AS movement FROM closing GROUP BY account""")

fragment("followed", "closing cohort_sales", """
  SELECT c.*, sale_period, CAST(datediff('quarter', sale_period, period) AS INTEGER) AS k
  FROM closing c JOIN cohort_sales s USING (account)
  WHERE datediff('quarter', sale_period, period) BETWEEN 0 AND 12""")

_surv = ", ".join(
    f"""max(CASE WHEN (k = {i} AND (age < 90 OR age IS NULL))
      OR CAST(sale_period + INTERVAL '{3 * i}' MONTH AS DATE) = DATE '1998-10-01' THEN 1 END) AS surv_{i},
    max(age) FILTER (WHERE k = {i}) AS age_{i}""" for i in N)
fragment("survival", "followed", f"""
  SELECT account, sale_period, max(unpaid_dt) AS max_unpaid_dt, {_surv}
  FROM followed WHERE mix <> '0P' GROUP BY account, sale_period""")


@case("survival_panel", "H1", "survival", "SELECT * FROM survival")
def _(inputs):
    return H.survival_panel(P.cohort_sales(inputs), inputs.closing, 12, "quarter", 90,
                            live=F.col("mix") != "0P", gap_periods=("1998-10-01",))


@case("survival_panel_with_missing", "H1", "followed cohort_sales", """
  SELECT s.account, s.sale_period, max(CASE WHEN k = 1 AND (age < 60 OR age IS NULL) THEN 1 END) AS surv_1,
    max(age) FILTER (WHERE k = 1) AS age_1
  FROM cohort_sales s LEFT JOIN (SELECT * FROM followed WHERE k BETWEEN 1 AND 3 AND status = 'F') f
    ON f.account = s.account GROUP BY s.account, s.sale_period""")
def _(inputs):
    rows = inputs.closing.where(F.col("status") == "F")
    panel = H.survival_panel(P.cohort_sales(inputs), rows, 3, "quarter", 60, keep_missing=True)
    return panel.select("account", "sale_period", "surv_1", "age_1")


_churn = ", ".join(["CASE WHEN surv_0 IS NULL THEN 1 END AS churn_0"] + [
    f"""CASE WHEN surv_{k - 1} = 1 AND surv_{k} IS NULL
      AND CAST(sale_period + INTERVAL '{3 * k}' MONTH AS DATE) < DATE '2001-07-01' THEN 1 END AS churn_{k}"""
    for k in N if k])
_types = ", ".join(
    f"CASE WHEN churn_{k} = 1 THEN CASE WHEN age_{k} >= 90 THEN 'Involuntary' ELSE 'Voluntary' END END AS churn_type_{k}"
    for k in N)
fragment("panel", "survival", f"SELECT *, {_types} FROM (SELECT *, {_churn} FROM survival) c")


@case("churn_periods", "H2", "panel",
      f"SELECT account, sale_period, {', '.join(f'churn_{k}' for k in N)} FROM panel")
def _(inputs):
    return P.panel(inputs).select("account", "sale_period", *[f"churn_{k}" for k in N])


@case("churn_types_by_period", "H3", "panel",
      f"SELECT account, sale_period, {', '.join(f'churn_type_{k}' for k in N)} FROM panel")
def _(inputs):
    return P.panel(inputs).select("account", "sale_period", *[f"churn_type_{k}" for k in N])


fragment("mortal", "panel cohort_sales", """
  SELECT p.*, rgus_sold, movement,
    CAST(surv_6 IS NULL AND p.sale_period <> DATE '2001-04-01' AS INTEGER) AS churned
  FROM panel p JOIN cohort_sales s ON s.account = p.account""")


@case("mortality_at_six", "H4", "mortal", """
  SELECT account, sale_period, rgus_sold, movement, churned FROM mortal""")
def _(inputs):
    return P.mortality(inputs).select("account", "sale_period", "rgus_sold", "movement", "churned")


fragment("cohort_rows", "snap", """
  SELECT * EXCLUDE (bill_dt), CASE WHEN age IS NOT NULL THEN unpaid_dt - 1 END AS bill_dt FROM snap""")
fragment("three_bills", "cohort_rows", f"""
  SELECT account, CAST(nth AS INTEGER) AS nth, CAST(bill_dt AS DATE) AS bill_dt, bill_amt FROM (
    SELECT account, bill_dt, bill_amt, row_number() OVER (PARTITION BY account ORDER BY dt) AS nth
    FROM (SELECT *, row_number() OVER (PARTITION BY account, {q('dt')} ORDER BY dt) AS in_period
          FROM cohort_rows WHERE bill_dt IS NOT NULL) r WHERE in_period = 1) b
  WHERE nth <= 3""")


@case("first_three_bills", "H5", "three_bills", "SELECT * FROM three_bills")
def _(inputs):
    return H.first_n_bills(P.cohort_rows(inputs), 3, "quarter")


_over = ", ".join(
    f"""max(age) FILTER (WHERE nth = {k}) AS max_age_bill_{k}, min(age) FILTER (WHERE nth = {k}) AS min_age_bill_{k},
    max(dt) FILTER (WHERE nth = {k}) AS last_day_bill_{k}, max(unpaid_dt) FILTER (WHERE nth = {k}) AS unpaid_bill_{k}"""
    for k in (1, 2, 3))
fragment("bill_overdue", "cohort_rows three_bills", f"""
  SELECT r.account, {_over} FROM cohort_rows r JOIN three_bills b
    ON b.account = r.account AND r.unpaid_dt = b.bill_dt + 1 GROUP BY r.account""")


@case("overdue_on_first_bills", "H6", "bill_overdue", "SELECT * FROM bill_overdue")
def _(inputs):
    rows = P.cohort_rows(inputs)
    return H.nth_bill_overdue(rows, H.first_n_bills(rows, 3, "quarter"), 3)


_flags = ", ".join(
    f"""CAST(coalesce(max_age_bill_{k} >= 90 AND churned = 1, false) AS INTEGER) AS churn_bill_{k},
    CAST(coalesce(max_age_bill_{k} >= 90 AND churned = 1 AND max_unpaid_dt - unpaid_bill_{k} > 2, false) AS INTEGER)
      AS rejoin_bill_{k}""" for k in (1, 2, 3))
fragment("cohort_flags", "mortal bill_overdue", f"""
  SELECT *, CAST(churned = 1 AND churn_bill_1 + churn_bill_2 + churn_bill_3 = 0 AS INTEGER) AS voluntary
  FROM (SELECT m.account, sale_period, movement, rgus_sold, churned, {_flags}
        FROM mortal m LEFT JOIN bill_overdue o ON o.account = m.account) f""")
_shown = ["account", "sale_period", "movement", "rgus_sold", "churned", "voluntary"] + [
    f"{k}_bill_{i}" for i in (1, 2, 3) for k in ("churn", "rejoin")]


@case("bill_cohort_flags", "H7", "cohort_flags", f"SELECT {', '.join(_shown)} FROM cohort_flags")
def _(inputs):
    return P.cohort_flags(inputs).select(*_shown)


@case("arpu_panel", "H8", "followed", "SELECT account, sale_period, " + ", ".join(
    f"max(bill_amt) FILTER (WHERE k = {k}) AS mrc_{k}, max(num_rgus) FILTER (WHERE k = {k}) AS rgus_{k}"
    for k in N) + " FROM followed WHERE mix <> '0P' GROUP BY account, sale_period")
def _(inputs):
    return P.arpu(inputs)


@case("sales_with_agent_and_deposit", "H9 C6", "cohort_sales profiled payments", f"""
  SELECT account, sale_period, rgus_sold, cust_type, bb_nm, tech, order_id, deposit_paid FROM (
    SELECT s.account, s.sale_period, rgus_sold, priority AS cust_type, bb_nm, tech, order_id,
      CASE WHEN s.account IN (SELECT account FROM payments) THEN s.account END AS deposit_paid,
      row_number() OVER (PARTITION BY s.account ORDER BY tech, order_id DESC) AS nth
    FROM cohort_sales s LEFT JOIN profiled p ON p.account = s.account AND {q('p.dt')} = s.sale_period) a
  WHERE nth = 1""")
def _(inputs):
    from abonara.functions.calendar import period_of
    attributes = inputs.profiled.select(
        "account", period_of(F.col("dt"), "quarter").alias("period"),
        F.col("priority").alias("cust_type"), "bb_nm", "tech", "order_id")
    sales = P.cohort_sales(inputs).select("account", "sale_period", "rgus_sold")
    return H.attach_agent(sales, attributes, inputs.payments, [F.asc("tech"), F.desc("order_id")])


_names = [f"{k}_bill_{i}" for i in (1, 2, 3) for k in ("churn", "rejoin")] + ["voluntary"]


@case("cohort_rollup", "H10", "cohort_flags", """
  SELECT sale_period, movement, count(DISTINCT account) AS sales, CAST(sum(rgus_sold) AS BIGINT) AS sales_rgus, """
      + ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}_accounts, "
                  f"CAST(sum(rgus_sold) FILTER (WHERE {n} = 1) AS BIGINT) AS {n}_rgus" for n in _names)
      + " FROM cohort_flags GROUP BY sale_period, movement")
def _(inputs):
    return H.cohort_rollup(P.cohort_flags(inputs), ["sale_period", "movement"], 3)


@case("survival_curve", "H11", "panel", "SELECT sale_period, count(*) AS accounts, " + ", ".join(
    f"CAST(sum(surv_{k}) AS BIGINT) AS alive_{k}" for k in N) + " FROM panel GROUP BY sale_period")
def _(inputs):
    return H.survival_curve(P.panel(inputs), 12)
