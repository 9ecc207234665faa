"""Snapshots, pairing and movements."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth, q
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.functions.calendar import complete_months, shift_period
from abonara.functions.profile import mobile_tenure_segment, tenure_segment
from abonara.operators import snapshot as S
from abonara.plans import tables as T

MONTH_COLUMNS = ["num_rgus", "mix", "age", "bill_amt"]


@case("opening_base_on_last_day", "D1", "profiled", f"""
  SELECT CAST({mth('dt')} + INTERVAL '1' MONTH AS DATE) AS period, account, dt AS b_date,
    num_rgus AS b_num_rgus, mix AS b_mix, age AS b_age, bill_amt AS b_bill_amt
  FROM profiled WHERE dt = last_day(dt) AND (age < 90 OR age IS NULL)""")
def _(inputs):
    return S.bom_snapshot(inputs.profiled, MONTH_COLUMNS, "month", 90, "last")


@case("opening_base_on_second_day", "D1", "profiled", f"""
  SELECT {mth('dt')} AS period, account, dt AS b_date, num_rgus AS b_num_rgus, mix AS b_mix,
    age AS b_age, bill_amt AS b_bill_amt
  FROM profiled WHERE day(dt) = 2 AND (age < 60 OR age IS NULL OR dt - unpaid_dt < 60)""")
def _(inputs):
    return S.bom_snapshot(inputs.profiled, MONTH_COLUMNS, "month", 60, "second", unpaid="unpaid_dt")


@case("closing_base_on_second_day", "D2", "profiled", f"""
  SELECT CAST({mth('dt')} - INTERVAL '1' MONTH AS DATE) AS period, account, dt AS e_date,
    num_rgus AS e_num_rgus, mix AS e_mix, age AS e_age, bill_amt AS e_bill_amt
  FROM profiled WHERE day(dt) = 2 AND (age <= 90 OR age IS NULL)""")
def _(inputs):
    return S.eom_snapshot(inputs.profiled, MONTH_COLUMNS, "month", 90, "second")


@case("closing_base_of_quarters", "D2", "closing", """
  SELECT period, account, dt AS e_date, num_rgus AS e_num_rgus, mix AS e_mix, age AS e_age,
    bill_amt AS e_bill_amt FROM closing WHERE age <= 90 OR age IS NULL""")
def _(inputs):
    return S.eom_snapshot(inputs.closing, MONTH_COLUMNS, "quarter", 90, None)


PAIR_COLUMNS = T.PAIR_COLUMNS
_b = ", ".join(f"b.{c} AS b_{c}" for c in ["dt"] + PAIR_COLUMNS).replace("b_dt", "b_date")
_e = ", ".join(f"e.{c} AS e_{c}" for c in ["dt"] + PAIR_COLUMNS).replace("e_dt", "e_date")

fragment("pair", "closing", f"""
  SELECT coalesce(b.next_period, e.period) AS period, coalesce(b.account, e.account) AS account,
    CAST(b.account IS NOT NULL AS INTEGER) AS active_bom,
    CAST(e.account IS NOT NULL AS INTEGER) AS active_eom, {_b}, {_e}
  FROM (SELECT *, CAST(period + INTERVAL '3' MONTH AS DATE) AS next_period FROM closing
        WHERE age_fix < 90 OR age_fix IS NULL OR dt - unpaid_dt < 90) b
  FULL JOIN (SELECT * FROM closing WHERE age_fix <= 90 OR age_fix IS NULL OR dt - unpaid_dt <= 90) e
    ON b.account = e.account AND b.next_period = e.period""")

_shown = """period, account, active_bom, active_eom, b_date, e_date, b_num_rgus, e_num_rgus,
    b_mix, e_mix, b_age, e_age, b_bill_amt, e_bill_amt"""


@case("paired_snapshots", "D3", "pair", f"SELECT {_shown} FROM pair")
def _(inputs):
    bom = S.bom_snapshot(inputs.closing, MONTH_COLUMNS, "quarter", 90, None, "age_fix", "unpaid_dt")
    eom = S.eom_snapshot(inputs.closing, MONTH_COLUMNS, "quarter", 90, None, "age_fix", "unpaid_dt")
    return S.pair_snapshots(bom, eom)


@case("paired_in_one_pass", "D1 D2 D3", "pair", f"SELECT {_shown} FROM pair")
def _(inputs):
    return S.pair_closing_rows(inputs.closing, MONTH_COLUMNS, "quarter", 90, "age_fix", "unpaid_dt")


MOVEMENT_CASE = f"""CASE WHEN e_num_rgus = b_num_rgus THEN '01. Same RGUs'
      WHEN e_num_rgus > b_num_rgus THEN '02. Upsell'
      WHEN e_num_rgus < b_num_rgus THEN '03. Downsell'
      WHEN b_num_rgus IS NULL AND e_num_rgus > 0 AND {mth('e_start_dt')} <> period
        AND datesub('month', e_max_inst_dt, period) <= 1 THEN '04. Come Back to Life'
      WHEN b_num_rgus IS NULL AND e_num_rgus > 0 AND datesub('month', e_start_dt, period) <= 1
        THEN '05. New Customer'
      WHEN active_bom = 1 AND active_eom = 0 THEN '06. Loss'
      WHEN b_num_rgus IS NULL AND e_num_rgus > 0 AND {mth('e_start_dt')} <> period
        THEN '07. Missing Customer' END"""

fragment("moved", "pair", f"""
  SELECT *, e_num_rgus - b_num_rgus AS rgu_change, {MOVEMENT_CASE} AS main_movement FROM pair""")


@case("main_movements", "D4", "moved", """
  SELECT period, account, active_bom, active_eom, rgu_change, main_movement FROM moved""")
def _(inputs):
    return T.movements(inputs).select(
        "period", "account", "active_bom", "active_eom", "rgu_change", "main_movement")


fragment("migrated", "closing", """
  SELECT DISTINCT CAST(a.period + INTERVAL '3' MONTH AS DATE) AS period, a.account
  FROM closing a JOIN closing b ON a.account = b.account
    AND b.period = CAST(a.period + INTERVAL '3' MONTH AS DATE)
  WHERE a.priority <> '1-URGENT' AND b.priority = '1-URGENT'""")


@case("main_movements_by_start_month", "D4", "pair migrated", f"""
  SELECT p.period, p.account,
    CASE WHEN e_num_rgus = b_num_rgus THEN '01. Same RGUs'
      WHEN e_num_rgus > b_num_rgus THEN '02. Upsell'
      WHEN e_num_rgus < b_num_rgus THEN '03. Downsell'
      WHEN b_num_rgus IS NULL AND e_num_rgus > 0 THEN
        CASE WHEN {mth('e_start_dt')} <> p.period THEN '04. Come Back to Life'
             ELSE '05. New Customer' END
      WHEN active_bom = 1 AND active_eom = 0 THEN
        CASE WHEN m.account IS NULL THEN '06. Loss' ELSE '07.B2C to B2B Adjustment' END
      END AS main_movement
  FROM pair p LEFT JOIN migrated m ON m.account = p.account AND m.period = p.period""")
def _(inputs):
    pair = T.pairs(inputs).join(T.migrations(inputs).withColumn("_m", F.lit(1)),
                                ["period", "account"], "left")
    return S.main_movement(pair, "start_month", F.col("_m") == 1).select(
        "period", "account", "main_movement")


@case("spins", "D5", "moved", """
  SELECT period, account, CASE WHEN main_movement = '01. Same RGUs' AND e_bill_amt > b_bill_amt
      THEN '1. Up-spin' WHEN main_movement = '01. Same RGUs' AND e_bill_amt < b_bill_amt
      THEN '2. Down-spin' ELSE '3. No Spin' END AS spin
  FROM moved""")
def _(inputs):
    return T.movements(inputs).select("period", "account", S.spin(
        F.col("b_bill_amt"), F.col("e_bill_amt"), F.col("main_movement")).alias("spin"))


fragment("mobile_pair", "mobile_closing", """
  SELECT coalesce(b.next_period, e.period) AS period,
    coalesce(b.mobile_account, e.mobile_account) AS mobile_account,
    CAST(b.mobile_account IS NOT NULL AS INTEGER) AS active_bom,
    CAST(e.mobile_account IS NOT NULL AS INTEGER) AS active_eom,
    b.fixed_contract AS b_fixed_contract, e.fixed_contract AS e_fixed_contract,
    b.mrc AS b_mrc, e.mrc AS e_mrc, b.start_dt AS b_start_dt, e.start_dt AS e_start_dt,
    b.email AS b_email, e.email AS e_email
  FROM (SELECT *, CAST(period + INTERVAL '3' MONTH AS DATE) AS next_period FROM mobile_closing) b
  FULL JOIN mobile_closing e
    ON b.mobile_account = e.mobile_account AND b.next_period = e.period""")

fragment("mobile_moved", "mobile_pair", """
  SELECT *, coalesce(nullif(nullif(b_fixed_contract, ''), '#N/D'),
      nullif(nullif(e_fixed_contract, ''), '#N/D'), mobile_account) AS fmc_account,
    CASE WHEN active_bom = 1 AND active_eom = 1 AND b_mrc = e_mrc THEN '01.Maintain'
      WHEN active_bom = 1 AND active_eom = 1 AND b_mrc > e_mrc THEN '02.Downspin'
      WHEN active_bom = 1 AND active_eom = 1 AND b_mrc < e_mrc THEN '03.Upspin'
      WHEN active_bom = 1 AND active_eom = 0 THEN '04.Loss'
      WHEN b_mrc IS NULL OR e_mrc IS NULL THEN '07.MRC Gap' END AS mobile_movement,
    CASE WHEN datesub('month', b_start_dt, period) < 6 THEN 'Early Tenure'
         WHEN datesub('month', b_start_dt, period) >= 6 THEN 'Late Tenure' END AS b_mobile_tenure,
    CASE WHEN datesub('month', e_start_dt, period) < 6 THEN 'Early Tenure'
         WHEN datesub('month', e_start_dt, period) >= 6 THEN 'Late Tenure' END AS e_mobile_tenure
  FROM mobile_pair""")


@case("mobile_movements", "D6 B7", "mobile_moved", """
  SELECT period, mobile_account, fmc_account, active_bom, active_eom, mobile_movement,
    b_mobile_tenure, e_mobile_tenure FROM mobile_moved""")
def _(inputs):
    return T.mobile_movements(inputs).select(
        "period", "mobile_account", "fmc_account", "active_bom", "active_eom", "mobile_movement",
        "b_mobile_tenure", "e_mobile_tenure")


@case("business_migrations", "D7", "migrated", "SELECT period, account FROM migrated")
def _(inputs):
    return T.migrations(inputs)


fragment("movement_counts", "moved", """
  SELECT period, active_bom, active_eom, main_movement, count(DISTINCT account) AS accounts,
    CAST(sum(b_num_rgus) AS BIGINT) AS b_rgus, CAST(sum(e_num_rgus) AS BIGINT) AS e_rgus
  FROM moved GROUP BY ALL""")


@case("movement_counts", "D8", "movement_counts", "SELECT * FROM movement_counts")
def _(inputs):
    return S.movement_summary(T.movements(inputs),
                              ["period", "active_bom", "active_eom", "main_movement"])
