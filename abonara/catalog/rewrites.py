"""The later forms of the fixed table, the never-paid cube, and saved sales-quality periods."""

from abonara.catalog import churn, contact, sales  # noqa: F401  (their fragments are needed)
from abonara.catalog.base_sql import mth, q, sql_list
from abonara.catalog.churn import LAST10, NEXT, _tenure
from abonara.catalog.cohort import _names
from abonara.catalog.periods import new_store
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.plans import never_paid as N
from abonara.plans import rewrites as R
from abonara.plans import sales_quality as Q
from abonara.plans import tables as T

_b = ", ".join(f"b.{c} AS b_{c}" for c in R.COLUMNS)
_e = ", ".join(f"e.{c} AS e_{c}" for c in R.COLUMNS)

fragment("pair92", "closing", f"""
  SELECT coalesce(b.next_period, e.period) AS period, coalesce(b.account, e.account) AS account,
    CAST(b.account IS NOT NULL AS INTEGER) AS active_bom, CAST(e.account IS NOT NULL AS INTEGER) AS active_eom,
    b.dt AS b_date, e.dt AS e_date, {_b}, {_e}
  FROM (SELECT *, {NEXT.format('period')} AS next_period FROM closing WHERE age < 92 OR age IS NULL) b
  FULL JOIN (SELECT * FROM closing WHERE age <= 92 OR age IS NULL) e ON b.account = e.account AND b.next_period = e.period""")


def _moved92(lost):
    return f"""
  SELECT m.*, {_tenure('b_tenure')} AS b_tenure_segment, {_tenure('e_tenure')} AS e_tenure_segment,
    CASE WHEN main_movement = '01. Same RGUs' AND e_bill_amt > b_bill_amt THEN '1. Up-spin'
         WHEN main_movement = '01. Same RGUs' AND e_bill_amt < b_bill_amt THEN '2. Down-spin' ELSE '3. No Spin' END AS spin
  FROM (SELECT p.*, e_num_rgus - b_num_rgus AS rgu_change,
      CASE WHEN e_num_rgus = b_num_rgus THEN '01. Same RGUs' WHEN e_num_rgus > b_num_rgus THEN '02. Upsell'
        WHEN e_num_rgus < b_num_rgus THEN '03. Downsell'
        WHEN b_num_rgus IS NULL AND e_num_rgus > 0 AND {mth('e_start_dt')} <> p.period THEN '04. Come Back to Life'
        WHEN b_num_rgus IS NULL AND e_num_rgus > 0 THEN '05. New Customer' {lost} END AS main_movement
    FROM pair92 p {"LEFT JOIN migrated m ON m.account = p.account AND m.period = p.period" if "m.account" in lost else ""}) m"""


_loss = "WHEN active_bom = 1 AND active_eom = 0 THEN '06. Loss'"
fragment("moved92", "pair92", _moved92(_loss))
fragment("moved92b", "pair92 migrated", _moved92(
    "WHEN active_bom = 1 AND active_eom = 0 AND m.account IS NOT NULL THEN '07.B2C to B2B Adjustment' " + _loss))

_gone = "active_bom = 1 AND active_eom = 0"


fragment("log_typed", "moved92b contract_moves balances", f"""
    SELECT m.*, c.* EXCLUDE (key, period), balance, CASE WHEN {_gone} AND {q('last_day')} = m.period
        AND last_code = 'BAJAS' AND last_kind = 'SALIDAS' THEN
          CASE WHEN last_description IN ('Bajas por solicitud voluntaria', 'No Determinada') THEN '{V.FIXED_VOLUNTARY}'
            WHEN last_description IN ('Bajas por morosidad', 'Bajas por Suspensión Morosidad') THEN '{V.FIXED_INVOLUNTARY}' END
        END AS churn_type
    FROM moved92b m LEFT JOIN contract_moves c ON c.key = {LAST10.format('m.account')} AND c.period = m.period
    LEFT JOIN balances b ON b.key = {LAST10.format('m.account')}""")


@case("log_fixed_table", "B7 D4 D5 D7 E8 E9 E10 E13", "pair92 log_typed", f"""
  SELECT t.* EXCLUDE (first_code, first_kind, last_code, last_kind, last_description, last_day, balance),
    CASE WHEN churn_type IS NULL AND main_movement = '06. Loss' AND last_code = 'CAMBIO PRODUCTO'
        AND last_kind = 'SALIDAS' THEN '01. Transfer Out'
      WHEN main_movement = '03. Downsell' AND last_code = 'CAMBIO PRODUCTO' AND last_kind = 'SALIDAS' AND balance < 0
        THEN '01. Transfer Out'
      WHEN main_movement = '05. New Customer' AND first_code = 'CAMBIO PRODUCTO' AND first_kind = 'ENTRADAS' THEN '02. Transfer In'
      WHEN main_movement = '02. Upsell' AND last_code IS NOT NULL AND balance > 0 THEN '02. Transfer In' END AS transfer_flag,
    CASE WHEN g.account IS NOT NULL THEN 'Rejoiner' END AS rejoiner_flag
  FROM log_typed t LEFT JOIN (SELECT account, {NEXT.format('period')} AS period FROM pair92 WHERE {_gone}) g
    ON g.account = t.account AND g.period = t.period""")
def _(inputs):
    return R.log_fixed_table(inputs.closing, inputs.movement_log, T.migrations(inputs), T.GRAIN)


_order = lambda cond, day, extra: f"""EXISTS (SELECT 1 FROM service_orders o WHERE o.account = m.account
    AND {q(day)} = m.period AND order_type = '{cond}' {extra})"""


fragment("order_marked", "moved92 snap service_orders", f"""
    SELECT m.*, EXISTS (SELECT 1 FROM snap s WHERE s.account = m.account AND {q('dt')} = m.period AND age >= 92) AS reached,
      {_order('DESINSTALACION', 'start', '')} AS ordered,
      {_order('DESINSTALACION', 'start', "AND command = 'MOROSIDAD'")} AS early,
      {_order('DESINSTALACION', 'completed', "AND (command IN ('TRAMITE INTERNO', 'DESINSTALACION POR TX') OR command LIKE 'MIGRACION%')")} AS outward,
      {_order('INSTALACION', 'completed', "AND command IN ('CAMBIO NOMBRE', 'INSTALACION POR TX', 'TRAMITE INTERNO')")} AS inward
    FROM moved92 m""")
fragment("order_typed", "order_marked", f"""
  SELECT * EXCLUDE (reached, ordered, early), CASE WHEN {_gone} THEN
      CASE WHEN NOT reached AND NOT ordered THEN '{V.FIXED_VOLUNTARY}' WHEN early THEN '3. Early Disconnection'
        WHEN reached THEN '{V.FIXED_INVOLUNTARY}' ELSE '{V.FIXED_VOLUNTARY}' END END AS churn_type FROM order_marked""")


@case("order_fixed_table", "B7 D4 D5 E5 E6 E7 E10 E13 E14", "moved92 order_typed", f"""
  SELECT t.* EXCLUDE (outward, inward),
    CASE WHEN (churn_type = '{V.FIXED_VOLUNTARY}' OR main_movement = '03. Downsell') AND outward THEN '01. Transfer Out'
      WHEN main_movement IN ('02. Upsell', '05. New Customer') AND inward THEN '02. Transfer In' END AS transfer_flag,
    CASE WHEN g.account IS NOT NULL THEN 'Rejoiner' END AS rejoiner_flag,
    CASE WHEN churn_type IN ('{V.FIXED_VOLUNTARY}', '{V.FIXED_INVOLUNTARY}') THEN b_num_rgus
      WHEN main_movement = '03. Downsell' THEN b_num_rgus - e_num_rgus ELSE 0 END AS rgu_churn
  FROM order_typed t LEFT JOIN (SELECT account, {NEXT.format('period')} AS period FROM moved92 WHERE main_movement = '06. Loss') g
    ON g.account = t.account AND g.period = t.period""")
def _(inputs):
    return R.order_fixed_table(inputs.closing, inputs.snap, inputs.service_orders, T.GRAIN)


# -- never-paid cube and saved sales quality ---------------------------------------------------

fragment("first_installs", "install_orders week_newcomers", """
  SELECT o.account, min(completed) AS first_install FROM install_orders o JOIN week_newcomers n
    ON n.account = o.account AND completed >= first_day GROUP BY o.account""")

fragment("cycle_info", "billed_sales sale_attrs week_newcomers first_installs", """
  SELECT c.*, CASE WHEN channel LIKE '%D2D%' THEN 'D2D' WHEN channel LIKE '%Digital%' THEN 'Digital' ELSE channel END
      AS sales_channel, sold_rgus, n.first_day AS first_seen, first_install
  FROM billed_sales c JOIN sale_attrs a ON a.account = c.account JOIN week_newcomers n ON n.account = c.account
  LEFT JOIN first_installs i ON i.account = c.account""")


@case("first_cycle_info", "G6 G7 G10 G12 G13", "cycle_info", "SELECT * FROM cycle_info")
def _(inputs):
    return N.first_cycle_info(inputs)


def _group_sql(c):
    whens = []
    for label, names, fragments in V.CHANNEL_GROUPS:
        tests = [f"{c} IN ({sql_list(names)})"] + [f"contains({c}, '{f}')" for f in fragments]
        whens.append(f"WHEN {' OR '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(whens)} END"


fragment("order_channels", "install_orders", f"""
  SELECT account, {_group_sql('channel')} AS order_channel
  FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY start, order_id) AS nth FROM install_orders
        WHERE completed BETWEEN DATE '{Q.RUN_WEEK}' AND DATE '{Q.RUN_WEEK}' + 6) o WHERE nth = 1""")

fragment("never_paid_rows", "drivers cycle_info order_channels", f"""
  SELECT x.*, order_channel FROM (
    SELECT coalesce(b.account, s.account) AS account, coalesce(b.period, DATE '{Q.RUN_WEEK}') AS period, segment,
      b.account AS in_base, s.account AS sold, {', '.join(N.SALE_FLAGS[1:])}, sales_channel, window_7, window_14, window_21,
      long_install, early_contact, early_ticket, bill_claim, no_plan_change, bill_shock, mounting_bill
    FROM drivers b FULL JOIN cycle_info s ON s.account = b.account AND b.period = DATE '{Q.RUN_WEEK}') x
  LEFT JOIN order_channels o ON o.account = x.account AND x.period = DATE '{Q.RUN_WEEK}'""")


@case("never_paid_driver_cube", "G12 G13 I13 B15", "never_paid_rows", f"""
  SELECT {', '.join(N.CUBE_DIMS)}, {', '.join(f'count(DISTINCT {f}) AS {f}' for f in N.CUBE_FLAGS)}
  FROM never_paid_rows GROUP BY {', '.join(N.CUBE_DIMS)}""")
def _(inputs):
    return N.never_paid_cube(inputs)


@case("sales_quality_saved_and_stacked", "A4 A5 H10", "cohort_flags", """
  SELECT sale_period, movement, count(DISTINCT account) AS sales, CAST(sum(rgus_sold) AS BIGINT) AS sales_rgus, """
      + ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}_accounts, "
                  f"CAST(sum(rgus_sold) FILTER (WHERE {n} = 1) AS BIGINT) AS {n}_rgus" for n in _names)
      + " FROM cohort_flags GROUP BY sale_period, movement")
def _(inputs):
    store = new_store(inputs, "sales_quality")
    N.save_sales_quality(inputs, store)
    return N.sales_quality_rollup(store)
