"""Standalone questions and cross-checks."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import q
from abonara.catalog.contact import wk
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.operators import checks as K
from abonara.operators import churn as E
from abonara.operators import sales as G
from abonara.plans import sales_quality as P
from abonara.plans import tables as T


@case("users_with_truck_roll", "K1", "usage contacts", f"""
  SELECT {wk('dt')} AS period, count(DISTINCT u.account) AS accounts FROM usage u
  JOIN contacts c ON c.account = u.account AND purpose = 'error' AND {wk('c.day')} = {wk('u.dt')} GROUP BY 1""")
def _(inputs):
    return K.users_with_purpose(inputs.usage, inputs.contacts, "error", "week")


@case("active_users_with_disconnect_order", "K2 B17", "snap service_orders", f"""
  SELECT {q('dt')} AS period, count(DISTINCT s.account) AS accounts FROM snap s
  JOIN service_orders o ON o.account = s.account AND order_type = 'DESINSTALACION' AND {q('start')} = {q('dt')}
  WHERE age < 90 GROUP BY 1""")
def _(inputs):
    return K.active_with_order(inputs.snap, inputs.service_orders, V.DEINSTALL, 90, "quarter")


@case("users_with_contact_and_order", "K3", "usage contacts install_orders", f"""
  SELECT {wk('dt')} AS period, count(DISTINCT u.account) AS accounts FROM usage u
  WHERE EXISTS (SELECT 1 FROM contacts c WHERE c.account = u.account AND c.purpose = 'click' AND {wk('c.day')} = {wk('u.dt')})
    AND EXISTS (SELECT 1 FROM install_orders o WHERE o.account = u.account AND {wk('o.start')} = {wk('u.dt')})
  GROUP BY 1""")
def _(inputs):
    clicks = inputs.contacts.where(F.col("purpose") == "click")
    return K.users_contact_and_order(inputs.usage, clicks, inputs.install_orders, "week")


@case("single_and_repeated_callers", "K4", "usage contacts", f"""
  SELECT c.period, CASE WHEN calls = 1 THEN 'Single caller' ELSE 'Repeated caller' END AS caller,
    count(*) AS accounts
  FROM (SELECT account, {wk('day')} AS period, count(DISTINCT interaction_id) AS calls FROM contacts
        WHERE purpose = 'purchase' GROUP BY 1, 2) c
  WHERE EXISTS (SELECT 1 FROM usage u WHERE u.account = c.account AND {wk('dt')} = c.period
    AND (age < 90 OR age IS NULL)) GROUP BY 1, 2""")
def _(inputs):
    return K.caller_split(inputs.usage, inputs.contacts, "purchase", 90, "week")


@case("accounts_with_order_near_contact", "K5", "usage contacts install_orders", f"""
  SELECT count(DISTINCT u.account) AS accounts FROM usage u
  JOIN contacts c ON c.account = u.account AND {wk('c.day')} = {wk('u.dt')} AND c.purpose = 'click'
  JOIN install_orders o ON o.account = u.account AND {wk('o.start')} = {wk('u.dt')}
  WHERE c.day - o.start <= 0""")
def _(inputs):
    clicks = inputs.contacts.where(F.col("purpose") == "click")
    return K.order_near_contact(inputs.usage, clicks, inputs.install_orders, 0, "week")


DIMS = ["b_fmc_type", "final_churn_flag", "partial_total_churn", "final_churn_type", "b_final_tenure",
        "b_final_tech", "waterfall"]


def _views():
    full = F.col("final_churn_flag") == "Full Churner"
    down = F.col("main_movement") == V.DOWNSELL
    partial = F.col("partial_total_churn") == "Partial Churner"
    cheaper = (F.col("mrc_change") < 0) & (F.col("b_total_rgus") == F.col("e_total_rgus"))
    lost = F.col("waterfall").isin("Downsell", "Full Churner")
    return [
        ("full churners", full, ["b_fmc_type", "final_churn_flag", "partial_total_churn"], "users"),
        ("full churners by type", full, ["final_churn_type"], "users"),
        ("full churners by tenure", full, ["b_final_tenure"], "users"),
        ("full churners by tech", full, ["b_final_tech"], "users"),
        ("downsells", down, ["b_fmc_type"], "users"),
        ("downsells by type", down, ["final_churn_type"], "users"),
        ("downsells by tech", down, ["b_final_tech"], "users"),
        ("partial churners by type", partial, ["final_churn_type"], "users"),
        ("partial churners by tech", partial, ["b_final_tech"], "users"),
        ("cheaper", cheaper, ["b_fmc_type"], "users"),
        ("cheaper by tech", cheaper, ["b_final_tech"], "users"),
        ("lost rgus", lost, ["waterfall", "final_churn_type"], "rgus"),
        ("lost rgus by tenure", lost, ["b_final_tenure"], "rgus"),
        ("lost rgus by tech", lost, ["b_final_tech"], "rgus"),
        ("lost accounts by tech and type", lost, ["b_final_tech", "final_churn_type"], "users"),
        ("lost accounts by tech, type and tenure", F.col("waterfall") == "Full Churner",
         ["b_final_tech", "final_churn_type", "b_final_tenure"], "users"),
    ]


def _view_sql(name, where, shown, value):
    cols = ", ".join(f"{d if d in shown.split() else 'NULL'}::VARCHAR AS {d}" for d in DIMS)
    return (f"SELECT '{name}' AS view, period, {cols}, CAST({value} AS DOUBLE) AS value FROM fmc_table "
            f"WHERE {where} GROUP BY period, {', '.join(shown.split())}")


_users, _accounts = "count(final_account)", "count(DISTINCT final_account)"
_rgus = "round(sum(b_total_rgus) - sum(coalesce(e_total_rgus, 0)), 4)"
_cheap = "mrc_change < 0 AND b_total_rgus = e_total_rgus"


@case("dashboard_counts", "K6", "fmc_table", " UNION ALL ".join([
    _view_sql("full churners", "final_churn_flag = 'Full Churner'", "b_fmc_type final_churn_flag partial_total_churn", _users),
    _view_sql("full churners by type", "final_churn_flag = 'Full Churner'", "final_churn_type", _users),
    _view_sql("full churners by tenure", "final_churn_flag = 'Full Churner'", "b_final_tenure", _users),
    _view_sql("full churners by tech", "final_churn_flag = 'Full Churner'", "b_final_tech", _users),
    _view_sql("downsells", "main_movement = '03. Downsell'", "b_fmc_type", _users),
    _view_sql("downsells by type", "main_movement = '03. Downsell'", "final_churn_type", _users),
    _view_sql("downsells by tech", "main_movement = '03. Downsell'", "b_final_tech", _users),
    _view_sql("partial churners by type", "partial_total_churn = 'Partial Churner'", "final_churn_type", _users),
    _view_sql("partial churners by tech", "partial_total_churn = 'Partial Churner'", "b_final_tech", _users),
    _view_sql("cheaper", _cheap, "b_fmc_type", _users),
    _view_sql("cheaper by tech", _cheap, "b_final_tech", _users),
    _view_sql("lost rgus", "waterfall IN ('Downsell', 'Full Churner')", "waterfall final_churn_type", _rgus),
    _view_sql("lost rgus by tenure", "waterfall IN ('Downsell', 'Full Churner')", "b_final_tenure", _rgus),
    _view_sql("lost rgus by tech", "waterfall IN ('Downsell', 'Full Churner')", "b_final_tech", _rgus),
    _view_sql("lost accounts by tech and type", "waterfall IN ('Downsell', 'Full Churner')", "b_final_tech final_churn_type", _accounts),
    _view_sql("lost accounts by tech, type and tenure", "waterfall = 'Full Churner'", "b_final_tech final_churn_type b_final_tenure", _accounts),
]))
def _(inputs):
    return K.dashboard_counts(T.fmc_table(inputs), _views(), DIMS)


@case("zero_product_rejoiners_recovered", "K7", "fixed_table profiled", f"""
  SELECT f.period, count(DISTINCT f.account) AS accounts FROM fixed_table f
  JOIN profiled p ON p.account = f.account AND {q('dt')} = f.period AND num_rgus > 0
  WHERE rejoiner_type = '2. Fixed Involuntary Rejoiner' GROUP BY 1""")
def _(inputs):
    return K.zero_p_recovered(T.fixed_table(inputs), inputs.profiled, "2. Fixed Involuntary Rejoiner", "quarter")


fragment("rgu_check", "fixed_table max_rgus service_orders", f"""
  SELECT f.account, f.period, f.b_mix, f.b_num_rgus,
    CAST(max_rgu_vo + max_rgu_tv + max_rgu_bb AS INTEGER) AS max_rgus, p.main_movement AS previous_movement,
    CAST(EXISTS (SELECT 1 FROM service_orders o WHERE o.account = f.account AND order_type = 'DESINSTALACION'
      AND status = 'FINALIZADA' AND {q('completed')} IN (f.period, CAST(f.period - INTERVAL '3' MONTH AS DATE))) AS INTEGER) AS has_order
  FROM fixed_table f JOIN max_rgus m ON m.account = f.account AND m.period = f.period
  LEFT JOIN fixed_table p ON p.account = f.account AND CAST(p.period + INTERVAL '3' MONTH AS DATE) = f.period
  WHERE f.churn_type = '1. Fixed Voluntary Churner' AND max_rgu_vo + max_rgu_tv + max_rgu_bb > f.b_num_rgus""")


def _checked(inputs):
    return K.rgu_adjust_check(
        T.fixed_table(inputs), E.max_rgus(inputs.snap, "quarter", 2),
        E.finished_disconnects(inputs.service_orders, "quarter"), V.FIXED_VOLUNTARY, "quarter")


@case("rgu_adjustment_check", "K8 E15", "rgu_check", "SELECT * FROM rgu_check")
def _(inputs):
    return _checked(inputs)


@case("unexplained_rgu_adjustments", "K8", "rgu_check", """
  SELECT b_mix, previous_movement, count(DISTINCT account) AS accounts, CAST(sum(b_num_rgus) AS BIGINT) AS rgus_before,
    CAST(sum(max_rgus) AS BIGINT) AS rgus_best FROM rgu_check WHERE has_order = 0 GROUP BY 1, 2""")
def _(inputs):
    return K.unexplained(_checked(inputs)).groupBy("b_mix", "previous_movement").agg(
        F.count_distinct("account").alias("accounts"), F.sum("b_num_rgus").alias("rgus_before"),
        F.sum("max_rgus").alias("rgus_best"))


@case("never_paid_sales_missing_from_base", "K9", "billed_sales dims", """
  SELECT account, first_bill, max_mrc, npn_7, npn_14, npn_21, npn FROM billed_sales
  WHERE account NOT IN (SELECT account FROM dims WHERE segment = 'HOUSEHOLD')""")
def _(inputs):
    table = inputs.dims.where(F.col("segment") == "HOUSEHOLD")
    return K.missing_from(P.billed_sales(inputs), table).select(
        "account", "first_bill", "max_mrc", "npn_7", "npn_14", "npn_21", "npn")


fragment("reconciled", "gross_adds service_orders", """
  SELECT coalesce(f.account, g.account) AS account, CASE WHEN g.account IS NULL THEN 'only digital file'
      WHEN f.account IS NULL THEN 'only gross adds' ELSE 'both' END AS found
  FROM (SELECT DISTINCT account FROM gross_adds WHERE channel = 'Telefono') f
  FULL JOIN (SELECT DISTINCT account FROM service_orders WHERE order_type = 'INSTALACION'
             AND status = 'FINALIZADA') g ON g.account = f.account""")


def _reconciled(inputs):
    digital = inputs.gross_adds.where(F.col("channel") == "Telefono")
    done = inputs.service_orders.where(
        (F.col("order_type") == V.INSTALL) & (F.col("status") == V.FINISHED))
    return K.reconcile(digital, done, ("digital file", "gross adds"))


@case("digital_sales_reconciled", "K10", "reconciled", "SELECT * FROM reconciled")
def _(inputs):
    return _reconciled(inputs)


@case("plan_changes_of_unmatched_sales", "K10 B19", "reconciled snap", """
  SELECT account FROM reconciled WHERE found = 'only digital file' AND account IN (
    SELECT account FROM (SELECT *, lag(vo_nm) OVER w AS p_vo, lag(tv_nm) OVER w AS p_tv, lag(bb_nm) OVER w AS p_bb
      FROM snap WINDOW w AS (PARTITION BY account ORDER BY dt)) c
    WHERE vo_nm <> p_vo OR tv_nm <> p_tv OR bb_nm <> p_bb)""")
def _(inputs):
    only = _reconciled(inputs).where(F.col("found") == "only digital file")
    return K.changed_products_of(only, inputs.snap)


@case("gone_but_not_never_paid", "K11", "panel billed_sales payments", """
  SELECT b.account, max_mrc, round(sum(amount), 2) AS paid FROM billed_sales b
  JOIN payments p ON p.account = b.account
  WHERE npn IS NULL AND b.account IN (SELECT account FROM panel WHERE surv_5 IS NULL)
  GROUP BY b.account, max_mrc""")
def _(inputs):
    return K.mortality_vs_npn(P.panel(inputs), P.billed_sales(inputs), inputs.payments, 5, "npn")


@case("gross_adds_against_new_accounts", "K12", "gross_adds fixed_table", f"""
  SELECT main_movement, count(DISTINCT g.account) FILTER (WHERE t.account IS NOT NULL) AS both,
    count(DISTINCT t.account) FILTER (WHERE g.account IS NULL) AS table_only,
    count(DISTINCT g.account) FILTER (WHERE t.account IS NULL) AS gross_only
  FROM (SELECT DISTINCT account FROM gross_adds WHERE sales_day BETWEEN '1999-01-01' AND '1999-03-31') g
  FULL JOIN (SELECT DISTINCT account, main_movement FROM fixed_table WHERE period = DATE '1999-01-01'
    AND main_movement IN ('04. Come Back to Life', '05. New Customer', '07. Missing Customer')) t ON t.account = g.account
  GROUP BY main_movement""")
def _(inputs):
    new = T.fixed_table(inputs).where(
        (F.col("period") == F.to_date(F.lit("1999-01-01")))
        & F.col("main_movement").isin(V.COME_BACK, V.NEW, V.MISSING))
    return K.reconcile_gross_fmc(
        G.first_sale_attrs(inputs.gross_adds, P.day("1999-01-01"), "quarter"), new, ["main_movement"])
