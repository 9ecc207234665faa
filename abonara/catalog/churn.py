"""Churn, transfers, rejoiners, and the fixed and mobile tables."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import q
from abonara.catalog.registry import case, fragment
from abonara.catalog.snapshot import MOVEMENT_CASE, PAIR_COLUMNS
from abonara.functions import values as V
from abonara.operators import churn as E
from abonara.plans import tables as T

NEXT = "CAST({0} + INTERVAL '3' MONTH AS DATE)"
LAST10 = "lpad(right({0}, 10), 10, '0')"

fragment("inactive", "pair", "SELECT * FROM pair WHERE active_bom = 1 AND active_eom = 0")


@case("inactive_accounts", "E1", "inactive", f"""
  SELECT period, account, '{V.FIXED_VOLUNTARY}' AS voluntary FROM inactive""")
def _(inputs):
    return E.inactive(T.pairs(inputs)).select("period", "account", "voluntary")


@case("voluntary_by_order", "E2", "inactive service_orders", f"""
  SELECT period, account, CASE WHEN EXISTS (SELECT 1 FROM service_orders o
      WHERE o.account = i.account AND order_type = 'DESINSTALACION' AND status = 'FINALIZADA'
        AND {q('completed')} BETWEEN CAST(i.period - INTERVAL '3' MONTH AS DATE) AND i.period)
    THEN '{V.FIXED_VOLUNTARY}' ELSE '3. Atipicos' END AS voluntary
  FROM inactive i""")
def _(inputs):
    lost = E.inactive(T.pairs(inputs)).select("period", "account")
    return E.voluntary_by_order(lost, inputs.service_orders, "quarter")


fragment("brackets", "repaired", f"""
  SELECT account, {q('dt')} AS period, min(dt) AS first_dt, max(dt) AS last_dt,
    arg_min_null(age_fix, dt) AS first_age, arg_max_null(age_fix, dt) AS last_age,
    CAST(arg_max(dt - unpaid_dt, dt) AS INTEGER) AS last_unpaid_days
  FROM repaired GROUP BY ALL""")


@case("record_brackets", "E3", "brackets", "SELECT * FROM brackets")
def _(inputs):
    return T.brackets(inputs)


fragment("involuntary", "brackets", f"""
  SELECT n.period, n.account, '{V.FIXED_INVOLUNTARY}' AS involuntary, n.last_age
  FROM brackets n JOIN brackets p ON p.account = n.account AND {NEXT.format('p.period')} = n.period
  WHERE (p.last_age < 90 OR p.last_unpaid_days < 90) AND (n.last_age >= 90 OR n.last_unpaid_days >= 90)""")


@case("involuntary_churners", "E4", "involuntary", "SELECT * FROM involuntary")
def _(inputs):
    return E.involuntary(T.brackets(inputs), 90, "quarter")


@case("involuntary_churners_from_boundary_days", "E4", "brackets", f"""
  SELECT n.period, n.account, '{V.FIXED_INVOLUNTARY}' AS involuntary, n.last_age
  FROM brackets n JOIN brackets p ON p.account = n.account AND {NEXT.format('p.period')} = n.period
  WHERE p.last_dt = n.period - 1
    AND (p.last_age < 90 OR p.last_unpaid_days < 90) AND (n.last_age >= 90 OR n.last_unpaid_days >= 90)""")
def _(inputs):
    return E.involuntary(T.brackets(inputs), 90, "quarter", "last")


fragment("reached", "inactive snap", f"""
  SELECT i.period, i.account, max(age) AS max_age, '{V.FIXED_INVOLUNTARY}' AS involuntary
  FROM inactive i JOIN snap s ON s.account = i.account AND {q('dt')} = i.period
  GROUP BY i.period, i.account HAVING max(age) >= 92""")


@case("reached_threshold", "E5", "reached", "SELECT * FROM reached")
def _(inputs):
    return E.reached_threshold(inputs.snap, E.inactive(T.pairs(inputs)), 92, "quarter")


fragment("merged", "inactive involuntary", f"""
  SELECT coalesce(i.period, v.period) AS period, coalesce(i.account, v.account) AS account,
    CASE WHEN i.account IS NOT NULL THEN '{V.FIXED_INVOLUNTARY}' ELSE '{V.FIXED_VOLUNTARY}' END AS churn_type
  FROM involuntary i FULL JOIN inactive v ON i.account = v.account AND i.period = v.period""")


@case("merged_churn_types", "E6", "merged", "SELECT * FROM merged")
def _(inputs):
    return E.merge_churn(E.inactive(T.pairs(inputs)), E.involuntary(T.brackets(inputs), 90, "quarter"))


fragment("churned", "moved merged", """
  SELECT m.*, CASE WHEN active_eom = 0 THEN churn_type END AS churn_type
  FROM moved m LEFT JOIN merged c ON c.account = m.account AND c.period = m.period""")


def churned(inputs):
    moved = T.movements(inputs)
    return E.merge_churn(E.inactive(moved), E.involuntary(T.brackets(inputs), 90, "quarter"), moved)


@case("churn_attached_to_movements", "E6", "churned", """
  SELECT period, account, main_movement, churn_type FROM churned""")
def _(inputs):
    return churned(inputs).select("period", "account", "main_movement", "churn_type")


fragment("early", "service_orders", f"""
  SELECT DISTINCT account, {q('start')} AS period FROM service_orders
  WHERE order_type = 'DESINSTALACION' AND command = 'MOROSIDAD'""")


@case("early_disconnects", "E7", "early", "SELECT * FROM early")
def _(inputs):
    return E.early_disconnect(inputs.service_orders, "quarter")


@case("threshold_churn_types", "E5 E6 E7", "inactive reached early", f"""
  SELECT i.period, i.account, CASE WHEN e.account IS NOT NULL THEN '3. Early Disconnection'
      WHEN r.account IS NOT NULL THEN '{V.FIXED_INVOLUNTARY}' ELSE '{V.FIXED_VOLUNTARY}' END AS churn_type
  FROM inactive i LEFT JOIN early e ON e.account = i.account AND e.period = i.period
  LEFT JOIN reached r ON r.account = i.account AND r.period = i.period""")
def _(inputs):
    lost = E.inactive(T.pairs(inputs)).select("period", "account")
    return E.threshold_churn(lost, E.reached_threshold(inputs.snap, lost, 92, "quarter"),
                             E.early_disconnect(inputs.service_orders, "quarter"))


fragment("contract_moves", "movement_log", f"""
  SELECT DISTINCT {LAST10.format('CAST(contract AS VARCHAR)')} AS key, period,
    first_value(code) OVER up AS first_code, first_value(kind) OVER up AS first_kind,
    first_value(code) OVER down AS last_code, first_value(kind) OVER down AS last_kind,
    first_value(description) OVER down AS last_description, first_value(day) OVER down AS last_day
  FROM (SELECT *, {q('day')} AS period FROM movement_log UNION ALL
        SELECT *, {q('day + 1')} AS period FROM movement_log WHERE {q('day + 1')} <> {q('day')}) l
  WINDOW up AS (PARTITION BY contract, period ORDER BY day, seq),
    down AS (PARTITION BY contract, period ORDER BY day DESC, seq DESC)""")


@case("contract_movements", "E8", "contract_moves", "SELECT * FROM contract_moves")
def _(inputs):
    return E.contract_movements(inputs.movement_log, "quarter")


fragment("log_churn", "inactive contract_moves", f"""
  SELECT i.period, i.account, CASE WHEN last_code = 'BAJAS' AND last_kind = 'SALIDAS' THEN
      CASE WHEN last_description IN ('Bajas por solicitud voluntaria', 'No Determinada')
             THEN '{V.FIXED_VOLUNTARY}'
           WHEN last_description IN ('Bajas por morosidad', 'Bajas por Suspensión Morosidad')
             THEN '{V.FIXED_INVOLUNTARY}' END END AS churn_type
  FROM inactive i LEFT JOIN contract_moves m
    ON m.key = {LAST10.format('i.account')} AND m.period = i.period""")


@case("movement_log_churn", "E8", "log_churn", "SELECT * FROM log_churn")
def _(inputs):
    return E.movement_log_churn(E.inactive(T.pairs(inputs)), E.contract_movements(inputs.movement_log, "quarter"))


fragment("balances", "movement_log", f"""
  SELECT {LAST10.format('CAST(contract AS VARCHAR)')} AS key,
    count(*) FILTER (WHERE code = 'CAMBIO PRODUCTO' AND kind = 'ENTRADAS')
      - count(*) FILTER (WHERE code = 'CAMBIO PRODUCTO' AND kind = 'SALIDAS') AS balance
  FROM movement_log GROUP BY ALL""")


@case("transfer_balances", "E9", "balances", "SELECT * FROM balances")
def _(inputs):
    return E.transfer_balance(inputs.movement_log)


@case("transfer_flags", "E10", "moved log_churn contract_moves balances", f"""
  SELECT m.period, m.account, main_movement, churn_type,
    CASE WHEN churn_type IS NULL AND main_movement = '06. Loss'
        AND last_code = 'CAMBIO PRODUCTO' AND last_kind = 'SALIDAS' THEN '01. Transfer Out'
      WHEN main_movement = '03. Downsell' AND last_code = 'CAMBIO PRODUCTO' AND last_kind = 'SALIDAS'
        AND balance < 0 THEN '01. Transfer Out'
      WHEN main_movement = '05. New Customer' AND first_code = 'CAMBIO PRODUCTO'
        AND first_kind = 'ENTRADAS' THEN '02. Transfer In'
      WHEN main_movement = '02. Upsell' AND c.key IS NOT NULL AND balance > 0
        THEN '02. Transfer In' END AS transfer_flag
  FROM moved m LEFT JOIN log_churn l ON l.account = m.account AND l.period = m.period
  LEFT JOIN contract_moves c ON c.key = {LAST10.format('m.account')} AND c.period = m.period
  LEFT JOIN balances b ON b.key = {LAST10.format('m.account')}""")
def _(inputs):
    moves = E.contract_movements(inputs.movement_log, "quarter")
    moved = T.movements(inputs).select("period", "account", "active_bom", "active_eom", "main_movement")
    typed = moved.join(E.movement_log_churn(E.inactive(moved), moves), ["period", "account"], "left")
    return E.transfer_flag(typed, moves, E.transfer_balance(inputs.movement_log)).drop(
        "active_bom", "active_eom")


@case("transfer_flags_by_orders", "E10", "churned service_orders", f"""
  SELECT c.period, c.account, CASE
      WHEN (churn_type = '{V.FIXED_VOLUNTARY}' OR main_movement = '03. Downsell') AND EXISTS (
        SELECT 1 FROM service_orders o WHERE o.account = c.account AND {q('completed')} = c.period
          AND order_type = 'DESINSTALACION' AND (command IN ('TRAMITE INTERNO', 'DESINSTALACION POR TX')
            OR command LIKE 'MIGRACION%')) THEN '01. Transfer Out'
      WHEN main_movement IN ('02. Upsell', '05. New Customer') AND EXISTS (
        SELECT 1 FROM service_orders o WHERE o.account = c.account AND {q('completed')} = c.period
          AND order_type = 'INSTALACION'
          AND command IN ('CAMBIO NOMBRE', 'INSTALACION POR TX', 'TRAMITE INTERNO'))
        THEN '02. Transfer In' END AS transfer_flag
  FROM churned c""")
def _(inputs):
    return E.transfer_flag_by_orders(churned(inputs), inputs.service_orders, "quarter").select(
        "period", "account", "transfer_flag")


fragment("mobile_churned", "mobile_moved typed_mobile_moves", f"""
  SELECT m.*, churn_type AS mobile_churn_type,
    coalesce(churn_type, '3. Mobile NonChurner') AS mobile_churn_flag,
    CAST(churn_type IS NOT NULL AS INTEGER) AS mobile_rgu_churn
  FROM mobile_moved m LEFT JOIN (
    SELECT mobile_account, {q('day')} AS period, min(churn_type) AS churn_type
    FROM typed_mobile_moves WHERE churn_type IS NOT NULL GROUP BY ALL) t
    ON t.mobile_account = m.mobile_account AND t.period = m.period
      AND active_bom = 1 AND active_eom = 0""")

fragment("mobile_table", "mobile_churned", f"""
  SELECT m.*, CASE p.mobile_churn_type
      WHEN '1. Mobile Voluntary Churner' THEN '1. Mobile Voluntary Rejoiner'
      WHEN '2. Mobile Involuntary Churner' THEN '2. Mobile Involuntary Rejoiner' END AS mobile_rejoiner_type
  FROM mobile_churned m LEFT JOIN mobile_churned p
    ON p.mobile_account = m.mobile_account AND {NEXT.format('p.period')} = m.period""")


@case("mobile_table", "D6 E11 E12", "mobile_table", "SELECT * FROM mobile_table")
def _(inputs):
    return T.mobile_table(inputs)


@case("mobile_churn_counts", "E11", "mobile_churned", """
  SELECT period, mobile_churn_flag, count(*) AS accounts, CAST(sum(mobile_rgu_churn) AS BIGINT) AS rgus
  FROM mobile_churned GROUP BY ALL""")
def _(inputs):
    return T.mobile_table(inputs).groupBy("period", "mobile_churn_flag").agg(
        F.count("*").alias("accounts"), F.sum("mobile_rgu_churn").alias("rgus"))


@case("fixed_rejoiners", "E12", "churned repaired", f"""
  SELECT DISTINCT {NEXT.format('c.period')} AS period, c.account,
    CASE churn_type WHEN '{V.FIXED_VOLUNTARY}' THEN '1. Fixed Voluntary Rejoiner'
      WHEN '{V.FIXED_INVOLUNTARY}' THEN '2. Fixed Involuntary Rejoiner' END AS rejoiner_type
  FROM churned c JOIN repaired r ON r.account = c.account AND {q('r.dt')} = {NEXT.format('c.period')}
  WHERE churn_type IS NOT NULL AND (age_fix <= 90
    OR (age_fix IS NULL AND {q('last_pay_dt')} = {q('r.dt')}))""")
def _(inputs):
    return E.rejoiners(churned(inputs), T.repaired(inputs), 90, "quarter")


@case("simple_rejoiners", "E13", "moved inactive", f"""
  SELECT m.period, m.account, CASE WHEN i.account IS NOT NULL THEN 'Rejoiner' END AS rejoiner_flag
  FROM moved m LEFT JOIN inactive i ON i.account = m.account AND {NEXT.format('i.period')} = m.period""")
def _(inputs):
    pair = T.movements(inputs)
    return E.rejoiner_simple(pair, E.inactive(pair), "quarter").select(
        "period", "account", "rejoiner_flag")


@case("rejoiners_of_losses", "E13", "moved", f"""
  SELECT m.period, m.account, CASE WHEN i.account IS NOT NULL THEN 'Rejoiner' END AS rejoiner_flag
  FROM moved m LEFT JOIN moved i ON i.account = m.account AND {NEXT.format('i.period')} = m.period
    AND i.main_movement = '06. Loss'""")
def _(inputs):
    pair = T.movements(inputs)
    return E.rejoiner_simple(pair, pair.where(F.col("main_movement") == V.LOSS), "quarter").select(
        "period", "account", "rejoiner_flag")


_sides = ",\n".join(
    f"CASE WHEN b.age_fix < 90 OR b.age_fix IS NULL OR b.dt - b.unpaid_dt < 90 THEN b.{c} END AS b_{c}, "
    f"CASE WHEN e.age_fix <= 90 OR e.age_fix IS NULL OR e.dt - e.unpaid_dt <= 90 THEN e.{c} END AS e_{c}" for c in PAIR_COLUMNS)

fragment("fixed_state", "closing", f"""
  SELECT coalesce(b.next_period, e.period) AS period, coalesce(b.account, e.account) AS account,
    CAST(b.account IS NOT NULL AND (b.age_fix < 90 OR b.age_fix IS NULL OR b.dt - b.unpaid_dt < 90) AS INTEGER) AS active_bom,
    CAST(e.account IS NOT NULL AND (e.age_fix <= 90 OR e.age_fix IS NULL OR e.dt - e.unpaid_dt <= 90) AS INTEGER) AS active_eom,
    b.dt AS b_date, e.dt AS e_date, coalesce((b.age_fix < 90 OR b.dt - b.unpaid_dt < 90) AND (e.age_fix >= 90 OR e.dt - e.unpaid_dt >= 90), false) AS crossed,
    coalesce(e.age_fix <= 90 OR (e.account IS NOT NULL AND e.age_fix IS NULL
        AND {q('e.last_pay_dt')} = e.period), false) AS paying,
    {_sides}
  FROM (SELECT *, CAST(period + INTERVAL '3' MONTH AS DATE) AS next_period FROM closing) b
  FULL JOIN closing e ON b.account = e.account AND b.next_period = e.period""")

fragment("fixed_typed", "fixed_state", f"""
  SELECT *, e_num_rgus - b_num_rgus AS rgu_change, {MOVEMENT_CASE} AS main_movement,
    CASE WHEN active_eom = 1 THEN NULL WHEN crossed THEN '{V.FIXED_INVOLUNTARY}'
         WHEN active_bom = 1 THEN '{V.FIXED_VOLUNTARY}' END AS churn_type
  FROM fixed_state""")


def _tenure(c):
    return f"""CASE WHEN {c} <= 6 THEN 'Early Tenure' WHEN {c} <= 12 THEN 'Mid Tenure'
      WHEN {c} > 12 THEN 'Late Tenure' END"""


fragment("held", "snap", f"""
  SELECT account, {q('dt')} AS period, CAST((count(vo_nm) > 0)::INTEGER + (count(bb_nm) > 0)::INTEGER
    + (count(tv_nm) > 0)::INTEGER AS INTEGER) AS held_rgus FROM snap GROUP BY ALL""")
fragment("first_rgus", "snap", """
  SELECT account, CAST((vo_nm IS NOT NULL)::INTEGER + (bb_nm IS NOT NULL)::INTEGER
    + (tv_nm IS NOT NULL)::INTEGER AS INTEGER) AS first_rgus
  FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY dt) AS nth FROM snap) s WHERE nth = 1""")

fragment("fixed_table", "fixed_typed held first_rgus", f"""
  SELECT t.* EXCLUDE (crossed, paying),
    CASE WHEN t.paying THEN CASE p.churn_type
      WHEN '{V.FIXED_VOLUNTARY}' THEN '1. Fixed Voluntary Rejoiner'
      WHEN '{V.FIXED_INVOLUNTARY}' THEN '2. Fixed Involuntary Rejoiner' END END AS rejoiner_type,
    CASE WHEN t.main_movement = '01. Same RGUs' AND t.e_bill_amt > t.b_bill_amt THEN '1. Up-spin'
         WHEN t.main_movement = '01. Same RGUs' AND t.e_bill_amt < t.b_bill_amt THEN '2. Down-spin'
         ELSE '3. No Spin' END AS spin,
    {_tenure('t.b_tenure')} AS b_tenure_segment, {_tenure('t.e_tenure')} AS e_tenure_segment,
    CASE WHEN t.churn_type = '{V.FIXED_INVOLUNTARY}' THEN held_rgus
         WHEN t.churn_type = '{V.FIXED_VOLUNTARY}' THEN first_rgus
         WHEN t.main_movement = '03. Downsell' THEN t.b_num_rgus - t.e_num_rgus ELSE 0 END AS rgu_churn,
    coalesce(t.b_vo_nm, '-') || coalesce(t.b_tv_nm, '-') || coalesce(t.b_bb_nm, '-') AS b_plan,
    coalesce(t.e_vo_nm, '-') || coalesce(t.e_tv_nm, '-') || coalesce(t.e_bb_nm, '-') AS e_plan
  FROM fixed_typed t
  LEFT JOIN fixed_typed p ON p.account = t.account AND {NEXT.format('p.period')} = t.period
  LEFT JOIN held h ON h.account = t.account AND h.period = t.period
  LEFT JOIN first_rgus f ON f.account = t.account
  WHERE t.active_bom = 1 OR t.active_eom = 1 OR t.churn_type IS NOT NULL""")


@case("fixed_table", "D3 D4 D5 B7 E1 E4 E6 E12 E14 B6", "fixed_table", "SELECT * FROM fixed_table")
def _(inputs):
    return T.fixed_table(inputs)


@case("rgu_churn_totals", "E14", "fixed_table", """
  SELECT period, churn_type, main_movement, count(*) AS accounts, CAST(sum(rgu_churn) AS BIGINT) AS rgus
  FROM fixed_table GROUP BY ALL""")
def _(inputs):
    return T.fixed_table(inputs).groupBy("period", "churn_type", "main_movement").agg(
        F.count("*").alias("accounts"), F.sum("rgu_churn").alias("rgus"))


fragment("max_rgus", "snap", f"""
  SELECT o.account, o.period, max((vo_nm IS NOT NULL)::INTEGER) AS max_rgu_vo,
    max((tv_nm IS NOT NULL)::INTEGER) AS max_rgu_tv, max((bb_nm IS NOT NULL)::INTEGER) AS max_rgu_bb
  FROM (SELECT account, {q('dt')} AS period FROM snap
        UNION SELECT account, {NEXT.format(q('dt'))} FROM snap) o
  JOIN snap s ON s.account = o.account AND {q('s.dt')} IN (o.period, CAST(o.period - INTERVAL '3' MONTH AS DATE))
  GROUP BY ALL""")


@case("most_rgus_of_two_periods", "E15", "max_rgus", """
  SELECT *, CAST(max_rgu_vo + max_rgu_tv + max_rgu_bb AS INTEGER) AS max_rgus FROM max_rgus""")
def _(inputs):
    return E.max_rgus(inputs.snap, "quarter", 2)


@case("churned_rgus", "E15", "fixed_table max_rgus", f"""
  SELECT f.period, f.account, CAST(max_rgu_vo + max_rgu_tv + max_rgu_bb AS INTEGER) AS max_rgus,
    CAST(max_rgu_vo + max_rgu_tv + max_rgu_bb - coalesce(e_num_rgus, 0) AS INTEGER) AS churned_rgus
  FROM fixed_table f LEFT JOIN max_rgus m ON m.account = f.account AND m.period = f.period
  WHERE churn_type IN ('{V.FIXED_VOLUNTARY}', '{V.FIXED_INVOLUNTARY}') OR main_movement = '03. Downsell'""")
def _(inputs):
    churners = E.churners_or_downsells(T.fixed_table(inputs))
    return E.churned_rgus(churners, E.max_rgus(inputs.snap, "quarter", 2)).select(
        "period", "account", "max_rgus", "churned_rgus")


@case("churner_profiles", "E16", "fixed_table snap", f"""
  SELECT f.period, f.account, f.churn_type, min(age) AS min_age, max(age) AS max_age
  FROM fixed_table f JOIN snap s ON s.account = f.account AND {q('dt')} = f.period
  WHERE churn_type IN ('{V.FIXED_VOLUNTARY}', '{V.FIXED_INVOLUNTARY}') OR main_movement = '03. Downsell'
  GROUP BY ALL""")
def _(inputs):
    churners = E.churners_or_downsells(T.fixed_table(inputs)).select("period", "account", "churn_type")
    return E.churner_profile(churners, inputs.snap, "quarter")


@case("last_active_days", "E17", "snap", """
  SELECT last_day, count(*) AS churners FROM (
    SELECT account, max(dt) AS last_day FROM snap
    WHERE dt BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' AND age < 90 GROUP BY account) l
  WHERE last_day BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' GROUP BY ALL""")
def _(inputs):
    day = lambda text: F.to_date(F.lit(text))
    return E.last_active_day(inputs.snap, (day("1995-01-01"), day("2001-12-31")),
                             (day("1998-01-01"), day("2000-12-31")))
