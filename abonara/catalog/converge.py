"""Convergence by contract and e-mail, by phone, and by household."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import q
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.operators import converge as C
from abonara.operators import converge_phone as CP
from abonara.plans import tables as T
from abonara.session import written

LAST10 = "lpad(right({0}, 10), 10, '0')"

fragment("shared_emails", "fixed_emails", """
  SELECT email, min(account) AS near_account, count(DISTINCT account) AS near_accounts
  FROM fixed_emails WHERE email <> 'NA@GMAIL.COM' GROUP BY email""")

fragment("near_mobile", "mobile_table shared_emails", """
  SELECT m.* EXCLUDE (active_bom, active_eom, b_start_dt, e_start_dt),
    active_bom AS mobile_active_bom, active_eom AS mobile_active_eom,
    b.email AS b_near_email, b.near_account AS b_near_account, b.near_accounts AS b_near_accounts,
    e.email AS e_near_email, e.near_account AS e_near_account, e.near_accounts AS e_near_accounts
  FROM mobile_table m LEFT JOIN shared_emails b ON b.email = m.b_email
  LEFT JOIN shared_emails e ON e.email = m.e_email""")


@case("near_fmc_by_email", "F1", "near_mobile", """
  SELECT period, mobile_account, b_near_email, b_near_account, b_near_accounts, e_near_email,
    e_near_account, e_near_accounts FROM near_mobile""")
def _(inputs):
    return T.near_mobile(inputs).select(
        "period", "mobile_account", *[f"{s}_near_{c}" for s in "be" for c in ("email", "account", "accounts")])


fragment("converged", "fixed_table near_mobile", f"""
  SELECT coalesce(f.period, m.period) AS period, f.account AS fixed_account,
    f.* EXCLUDE (period, account), m.* EXCLUDE (period),
    coalesce(f.account, '') || coalesce(m.mobile_account, '') AS final_account,
    CAST(coalesce(active_bom, 0) + coalesce(mobile_active_bom, 0) > 0 AS INTEGER) AS final_bom_active,
    CAST(coalesce(active_eom, 0) + coalesce(mobile_active_eom, 0) > 0 AS INTEGER) AS final_eom_active
  FROM fixed_table f FULL JOIN near_mobile m
    ON {LAST10.format('f.account')} = {LAST10.format('m.fmc_account')} AND f.period = m.period""")


@case("converged_accounts", "F2", "converged", """
  SELECT period, fixed_account, mobile_account, final_account, final_bom_active, final_eom_active,
    main_movement, mobile_movement FROM converged""")
def _(inputs):
    return T.converged(inputs).select(
        "period", "fixed_account", "mobile_account", "final_account", "final_bom_active",
        "final_eom_active", "main_movement", "mobile_movement")


def _status(s, when, extra):
    f, m, c = f"coalesce(active_{when}, 0)", f"coalesce(mobile_active_{when}, 0)", f"{s}_fixed_contract"
    return f"""CASE WHEN {f} = 1 AND {m} = 1 AND {c} IS NOT NULL THEN 'Soft FMC'
      WHEN {f} = 1 AND ({m} = 1 OR ({s}_near_email IS NOT NULL AND {c} IS NULL)) THEN 'Near FMC'
      WHEN {f} = 1 THEN 'Fixed Only' WHEN {m} = 1{extra} THEN 'Mobile Only' END"""


fragment("fmc1", "converged", f"""
  SELECT *, {_status('b', 'bom', '')} AS b_fmc_status,
    {_status('e', 'eom', ' AND mobile_churn_type IS NULL')} AS e_fmc_status,
    CAST(coalesce(mobile_active_bom, 0) = 1 AS INTEGER) AS b_mobile_rgus,
    CAST(coalesce(mobile_active_eom, 0) = 1 AS INTEGER) AS e_mobile_rgus
  FROM converged""")

fragment("fmc2", "fmc1", """
  SELECT *,
    CASE WHEN b_fmc_status IN ('Fixed Only', 'Soft FMC', 'Near FMC') AND b_mobile_rgus = 0
          AND b_mix IN ('1P', '2P', '3P') THEN 'Fixed ' || b_mix
      WHEN b_fmc_status IN ('Soft FMC', 'Near FMC') AND coalesce(active_bom, 0) = 0 THEN 'Mobile Only'
      WHEN b_fmc_status IN ('Mobile Only', 'Near FMC', 'Soft FMC') THEN b_fmc_status
      WHEN final_bom_active = 1 AND b_num_rgus = 0 THEN 'Fixed 0P' END AS b_fmc_type,
    CASE WHEN e_fmc_status = 'Fixed Only' AND churn_type IS NOT NULL THEN NULL
      WHEN e_fmc_status = 'Mobile Only' AND mobile_churn_type IS NOT NULL THEN NULL
      WHEN e_fmc_status = 'Fixed Only' AND (e_mobile_rgus = 0 OR mobile_churn_type IS NOT NULL)
          AND e_mix IN ('1P', '2P', '3P') THEN 'Fixed ' || e_mix
      WHEN (e_fmc_status IN ('Soft FMC', 'Near FMC') AND (coalesce(active_eom, 0) = 0 OR churn_type IS NOT NULL))
          OR e_fmc_status = 'Mobile Only' OR (coalesce(active_eom, 0) = 0 AND e_mobile_rgus = 1)
        THEN 'Mobile Only'
      WHEN e_fmc_status IN ('Soft FMC', 'Near FMC') AND churn_type IS NULL AND mobile_churn_type IS NULL
          AND active_eom = 1 AND e_mobile_rgus = 1 THEN e_fmc_status
      WHEN final_eom_active = 1 AND e_num_rgus = 0 THEN 'Fixed 0P' END AS e_fmc_type
  FROM fmc1""")

fragment("fmc3", "fmc2", """
  SELECT *,
    CASE WHEN b_fmc_status = 'Fixed Only' OR (b_fmc_status IN ('Soft FMC', 'Near FMC')
          AND active_bom = 1 AND b_mobile_rgus = 1) THEN b_tech
      WHEN b_fmc_status = 'Mobile Only' OR (b_fmc_status IN ('Soft FMC', 'Near FMC')
          AND coalesce(active_bom, 0) = 0) THEN 'Wireless' END AS b_final_tech,
    CASE WHEN churn_type IS NULL AND (e_fmc_status = 'Fixed Only' OR (e_fmc_status IN ('Soft FMC', 'Near FMC')
          AND active_eom = 1 AND e_mobile_rgus = 1)) THEN e_tech
      WHEN e_fmc_status = 'Mobile Only' OR (e_fmc_status IN ('Soft FMC', 'Near FMC')
          AND coalesce(active_eom, 0) = 0) THEN 'Wireless' END AS e_final_tech,
    coalesce(b_tenure_segment, b_mobile_tenure) AS b_final_tenure,
    CASE WHEN churn_type IS NULL AND e_tenure_segment IS NOT NULL THEN e_tenure_segment
      WHEN mobile_churn_type IS NULL THEN e_mobile_tenure END AS e_final_tenure,
    CASE WHEN b_fmc_type IN ('Soft FMC', 'Near FMC') AND b_mix IN ('0P', '1P', '2P', '3P')
        THEN CASE b_mix WHEN '0P' THEN 'P0' WHEN '1P' THEN 'P2' WHEN '2P' THEN 'P3' ELSE 'P4' END
      WHEN b_fmc_type LIKE 'Fixed _P' AND b_fmc_type <> 'Fixed 0P' THEN 'P1_Fixed'
      WHEN b_fmc_type IN ('Soft FMC', 'Near FMC') AND b_mobile_rgus = 0 AND active_bom = 1 THEN 'P1_Fixed'
      WHEN b_fmc_type = 'Mobile Only' OR (b_fmc_type = 'Soft FMC' AND coalesce(active_bom, 0) = 0
          AND b_mobile_rgus = 1) THEN 'P1_Mobile'
      WHEN b_fmc_type = 'Fixed 0P' THEN 'P0_Fixed' END AS b_fmc_segment,
    CASE WHEN e_fmc_type IN ('Soft FMC', 'Near FMC') AND active_eom = 1 AND e_mobile_rgus = 1
          AND churn_type IS NULL AND mobile_churn_type IS NULL AND e_mix IN ('1P', '2P', '3P')
        THEN CASE e_mix WHEN '1P' THEN 'P2' WHEN '2P' THEN 'P3' ELSE 'P4' END
      WHEN (e_fmc_type IN ('Fixed 1P', 'Fixed 2P', 'Fixed 3P')
          OR (e_fmc_type IN ('Soft FMC', 'Near FMC') AND e_mobile_rgus = 0))
        AND active_eom = 1 AND churn_type IS NULL THEN 'P1_Fixed'
      WHEN (e_fmc_type = 'Mobile Only' OR (e_fmc_type = 'Soft FMC' AND coalesce(active_eom, 0) = 0))
        AND e_mobile_rgus = 1 AND mobile_churn_type IS NULL THEN 'P1_Mobile'
      WHEN e_fmc_type = 'Fixed 0P' OR (e_fmc_type IN ('Soft FMC', 'Near FMC') AND e_mobile_rgus = 0
          AND active_eom = 1) THEN 'P0_Fixed'
      WHEN e_fmc_type IN ('Soft FMC', 'Near FMC') AND e_mix = '0P' THEN 'P0' END AS e_fmc_segment,
    CASE WHEN churn_type IS NOT NULL AND mobile_churn_type IS NOT NULL THEN 'Full Churner'
      WHEN b_fmc_status = 'Fixed Only' AND churn_type IS NOT NULL THEN 'Full Churner'
      WHEN b_fmc_status = 'Mobile Only' AND mobile_churn_type IS NOT NULL THEN 'Full Churner'
      WHEN churn_type IS NULL AND active_bom = 1 AND b_mobile_rgus = 1 AND coalesce(active_eom, 0) = 0
          AND e_mobile_rgus = 0 THEN 'Full Churner'
      WHEN churn_type IS NOT NULL THEN 'Fixed Churner'
      WHEN mobile_churn_type IS NOT NULL THEN 'Mobile Churner'
      ELSE 'Non Churner' END AS final_churn_flag,
    CASE WHEN fixed_account IS NULL THEN 1
         ELSE count(*) OVER (PARTITION BY period, fixed_account) END AS copies
  FROM fmc2""")

fragment("fmc4", "fmc3", """
  SELECT *, round(e_total_mrc, 0) - round(b_total_mrc, 0) AS mrc_change FROM (SELECT *,
    coalesce(round(b_bill_amt, 0), 0) / copies + coalesce(round(b_mrc, 0), 0) AS b_total_mrc,
    coalesce(round(e_bill_amt, 0), 0) / copies + coalesce(round(e_mrc, 0), 0) AS e_total_mrc,
    (coalesce(b_num_rgus, 0) + b_mobile_rgus) / copies AS b_total_rgus,
    (coalesce(e_num_rgus, 0) + e_mobile_rgus) / copies AS e_total_rgus,
    coalesce(rgu_churn, 0) / copies + coalesce(mobile_rgu_churn, 0) AS total_rgu_churn,
    CASE WHEN rejoiner_type IS NULL AND mobile_rejoiner_type IS NULL THEN NULL
      WHEN (rejoiner_type IS NOT NULL AND mobile_rejoiner_type IS NOT NULL)
        OR e_fmc_type IN ('Soft FMC', 'Near FMC') THEN 'FMC Rejoiner'
      WHEN rejoiner_type IS NOT NULL THEN 'Fixed Rejoiner' ELSE 'Mobile Rejoiner' END AS rejoiner_flag,
    CASE final_churn_flag WHEN 'Full Churner' THEN 'Total Churner' WHEN 'Fixed Churner' THEN 'Partial Churner'
      WHEN 'Mobile Churner' THEN 'Partial Churner' END AS partial_total_churn,
    CASE WHEN churn_type LIKE '1.%' OR mobile_churn_type LIKE '1.%' AND churn_type IS NULL THEN 'Voluntary'
      WHEN mobile_churn_type LIKE '1.%' THEN 'Voluntary'
      WHEN churn_type LIKE '2.%' OR mobile_churn_type LIKE '2.%' THEN 'Involuntary'
      WHEN main_movement = '03. Downsell' THEN 'Voluntary' END AS final_churn_type
  FROM fmc3) t""")

fragment("fmc_table", "fmc4", """
  SELECT *, CASE WHEN waterfall = 'Downspin' THEN 'Voluntary' END AS downspin_split,
    CASE WHEN waterfall = 'Downsell' THEN CASE WHEN main_movement = '03. Downsell' THEN 'Voluntary'
      WHEN main_movement = '06. Loss' THEN 'Undefined' END END AS downsell_split
  FROM (SELECT *,
    CASE WHEN final_churn_flag <> 'Non Churner' THEN final_churn_flag
      WHEN b_total_rgus = e_total_rgus AND b_total_mrc = e_total_mrc THEN 'Maintain'
      WHEN b_total_rgus < e_total_rgus THEN 'Upsell' WHEN b_total_rgus > e_total_rgus THEN 'Downsell'
      WHEN b_total_mrc < e_total_mrc THEN 'Upspin' WHEN b_total_mrc > e_total_mrc THEN 'Downspin'
      END AS waterfall,
    coalesce(b_plan, '') || coalesce(CAST(mobile_active_bom AS VARCHAR), '-') AS b_plan_full,
    coalesce(e_plan, '') || coalesce(CAST(mobile_active_eom AS VARCHAR), '-') AS e_plan_full
  FROM fmc4) w""")

_key = ["period", "final_account"]


def _fmc_case(name, ids, columns):
    shown = _key + columns.split()

    @case(name, ids, "fmc_table", f"SELECT {', '.join(shown)} FROM fmc_table")
    def run(inputs):
        return T.fmc_table(inputs).select(*shown)


_fmc_case("fmc_statuses", "F3", "b_fmc_status e_fmc_status")
_fmc_case("fmc_types", "F4", "b_fmc_type e_fmc_type b_mobile_rgus e_mobile_rgus")
_fmc_case("final_tech_and_tenure", "F5", "b_final_tech e_final_tech b_final_tenure e_final_tenure")
_fmc_case("fmc_segments", "F6", "b_fmc_segment e_fmc_segment")
_fmc_case("final_churn_flags", "F7", "final_churn_flag")
_fmc_case("fmc_totals", "F8 C8", "copies b_total_rgus e_total_rgus b_total_mrc e_total_mrc mrc_change total_rgu_churn")
_fmc_case("final_rejoiners", "F9", "rejoiner_flag")
_fmc_case("partial_and_total_churn", "F10", "partial_total_churn final_churn_type")
_fmc_case("fmc_waterfall_labels", "F11 B6", "waterfall b_plan_full e_plan_full")
_fmc_case("downsell_and_downspin_splits", "F12", "downsell_split downspin_split")


# -- the phone-matched market ----------------------------------------------------------

def _number(expr):
    return f"'7' || lpad(CAST({expr} AS VARCHAR), 9, '0')"


def _fixed_side(s, when):
    return f"""active_{when} AS fix_{s}_active, replace({s}_tenure_segment, ' ', '-') AS fix_{s}_tenure,
    round({s}_bill_amt, 0) AS fix_{s}_mrc, {s}_num_rgus AS fix_{s}_rgus, {s}_mix AS fix_{s}_mix,
    {s}_tech AS fix_{s}_tech, {s}_bb_nm || '-' || CAST({s}_num_rgus AS VARCHAR) AS fix_{s}_bill_code,
    {s}_age AS fix_{s}_overdue"""


fragment("phone_fixed", "fixed_table", f"""
  SELECT period, account AS fixed_account, {_number('CAST(account AS BIGINT)')} AS phone1,
    {_number('CAST(account AS BIGINT) + 1')} AS phone2,
    CASE WHEN churn_type IS NULL THEN '2. Fixed NonChurner' ELSE '1. Fixed Churner' END AS fix_churn_flag,
    CASE WHEN churn_type = '{V.FIXED_VOLUNTARY}' AND b_mix = '0P' THEN '3. Fixed 0P Churner'
      WHEN churn_type = '{V.FIXED_VOLUNTARY}' AND b_mix = '3P' THEN '3. Fixed Transfer'
      ELSE churn_type END AS fix_churn_type,
    CASE main_movement WHEN '05. New Customer' THEN '4.New Customer'
      WHEN '04. Come Back to Life' THEN '5.Come Back to Life' WHEN '06. Loss' THEN '6.Null last day'
      WHEN '07. Missing Customer' THEN '7.Transfer Adds' END AS fix_movement,
    CAST(rejoiner_type IS NOT NULL AS INTEGER) AS fix_rejoiner,
    CASE WHEN e_tech = 'FTTH' THEN e_start_dt END AS fix_e_start,
    {_fixed_side('b', 'bom')}, {_fixed_side('e', 'eom')}
  FROM fixed_table""")


def _mobile_side(s, when):
    return f"""active_{when} AS mob_{s}_active, replace({s}_mobile_tenure, ' ', '-') AS mob_{s}_tenure,
    {s}_mrc AS mob_{s}_mrc, active_{when} AS mob_{s}_rgus"""


fragment("phone_mobile", "mobile_table", f"""
  SELECT period, mobile_account,
    CASE WHEN mobile_churn_type IS NULL THEN '2. Mobile NonChurner' ELSE '1. Mobile Churner' END AS mob_churn_flag,
    mobile_churn_type AS mob_churn_type,
    CASE WHEN active_bom = 0 AND e_mobile_tenure = 'Early Tenure' THEN '4.New Customer'
      WHEN active_bom = 0 THEN '5.Come Back to Life' END AS mob_movement,
    CAST(mobile_rejoiner_type IS NOT NULL AS INTEGER) AS mob_rejoiner,
    {_mobile_side('b', 'bom')}, {_mobile_side('e', 'eom')}
  FROM mobile_table""")

fragment("phone_matches", "phone_fixed phone_mobile", """
  SELECT period, fixed_account, mobile_account, CAST(row_number() OVER (
      PARTITION BY period, mobile_account ORDER BY fixed_account DESC) AS INTEGER) AS match_rank
  FROM (SELECT f.period, fixed_account, mobile_account,
      row_number() OVER (PARTITION BY f.period, fixed_account ORDER BY mobile_account DESC) AS row_fix,
      row_number() OVER (PARTITION BY f.period, mobile_account ORDER BY fixed_account DESC) AS row_mob
    FROM phone_fixed f JOIN phone_mobile m
      ON f.period = m.period AND m.mobile_account IN (f.phone1, f.phone2)) p
  WHERE row_fix = 1 AND row_mob <= 2""")


@case("phone_matches", "F13 C9", "phone_matches", "SELECT * FROM phone_matches")
def _(inputs):
    return CP.phone_converge(T.phone_fixed(inputs), T.phone_mobile(inputs))


def _merged_tenure(s):
    f, m = f"fix_{s}_tenure", f"mob_{s}_tenure"
    return f"""CASE WHEN {f} IS NULL THEN {m} WHEN {m} IS NULL OR {f} = {m} THEN {f}
      WHEN 'Early-Tenure' IN ({f}, {m}) THEN 'Early-Tenure'
      WHEN 'Mid-Tenure' IN ({f}, {m}) THEN 'Mid-Tenure' END"""


def _sums(s):
    return f"""CAST(coalesce(fix_{s}_active, 0) + coalesce(mob_{s}_active, 0) >= 1 AS INTEGER) AS fmc_{s}_active,
    {_merged_tenure(s)} AS fmc_{s}_tenure,
    CAST(coalesce(fix_{s}_rgus, 0) + coalesce(mob_{s}_rgus, 0) AS INTEGER) AS fmc_{s}_rgus,
    coalesce(fix_{s}_mrc, 0) + coalesce(mob_{s}_mrc, 0) AS fmc_{s}_mrc"""


fragment("phone_base", "phone_matches", f"""
  SELECT coalesce(f.period, m.period) AS period, f.* EXCLUDE (period, matched, match_rank),
    m.* EXCLUDE (period),
    CASE WHEN f.fixed_account IS NULL THEN m.mobile_account WHEN m.mobile_account IS NULL THEN f.fixed_account
      ELSE f.fixed_account || ' - ' || m.mobile_account END AS fmc_account,
    CASE WHEN m.mobile_account IS NULL THEN 1 ELSE coalesce(match_rank, 1) END AS mobile_copy,
    {_sums('b')}, {_sums('e')}
  FROM (SELECT x.*, p.mobile_account AS matched, p.match_rank FROM phone_fixed x
        LEFT JOIN phone_matches p ON p.fixed_account = x.fixed_account AND p.period = x.period) f
  FULL JOIN phone_mobile m ON m.mobile_account = f.matched AND m.period = f.period""")


def _phone_tables(inputs):
    """Both tables of this market, saved: matching and joining read them."""
    return written(T.phone_fixed(inputs), "phone_fixed"), written(T.phone_mobile(inputs), "phone_mobile")


@case("phone_fmc_base", "F14", "phone_base", """
  SELECT period, fmc_account, fixed_account, mobile_account, mobile_copy, fmc_b_active, fmc_e_active,
    fmc_b_tenure, fmc_e_tenure, fmc_b_rgus, fmc_e_rgus, fmc_b_mrc, fmc_e_mrc FROM phone_base""")
def _(inputs):
    return T.phone_fmc_base(*_phone_tables(inputs)).select(
        "period", "fmc_account", "fixed_account", "mobile_account", "mobile_copy",
        *[f"fmc_{s}_{c}" for s in "be" for c in ("active", "tenure", "rgus", "mrc")])


fragment("prepaid_phones", "", f"""
  SELECT {_number('o_custkey')} AS phone, max(CAST(o_orderstatus = 'O' AS INTEGER)) AS on_b,
    max(CAST(o_orderstatus = 'F' AS INTEGER)) AS on_e
  FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1""")


def _class(s):
    f, m = f"coalesce(fix_{s}_active, 0)", f"coalesce(mob_{s}_active, 0)"
    listed = f"coalesce(p1.on_{s}, 0) + coalesce(p2.on_{s}, 0) > 0"
    kind = (f"CASE WHEN fix_{s}_bill_code IN ('PROMO-1', 'LARGE-2', 'LARGE-3') THEN 'Real FMC' "
            "ELSE 'Near FMC' END")
    return f"""CASE WHEN {f} = 1 AND {m} = 0 THEN
        CASE WHEN {listed} THEN 'Prepaid ' || {kind} ELSE 'Fixed Only' END
      WHEN {f} = 0 AND {m} = 1 THEN 'Mobile Only'
      WHEN {f} = 1 AND {m} = 1 THEN CASE WHEN {listed} THEN {kind} ELSE 'Postpaid ' || {kind} END END"""


fragment("phone_class", "phone_base prepaid_phones", f"""
  SELECT b.*, {_class('b')} AS fmc_b_class, {_class('e')} AS fmc_e_class
  FROM phone_base b LEFT JOIN prepaid_phones p1 ON p1.phone = b.phone1
  LEFT JOIN prepaid_phones p2 ON p2.phone = b.phone2""")


@case("phone_fmc_classes", "F15", "phone_class", """
  SELECT period, fmc_account, fmc_b_class, fmc_e_class FROM phone_class""")
def _(inputs):
    return T.phone_fmc_adjusted(*_phone_tables(inputs), T.prepaid_phones(inputs)).select("period", "fmc_account", "fmc_b_class", "fmc_e_class")


def _segment(s):
    return f"""CASE fmc_{s}_class WHEN 'Fixed Only' THEN fix_{s}_mix || ' Fixed' WHEN 'Mobile Only' THEN 'P1 Mobile'
      ELSE CAST(CAST(left(fix_{s}_mix, 1) AS INTEGER) + 1 AS VARCHAR) || 'P ' || fmc_{s}_class END AS fmc_{s}_segment,
    CASE WHEN fmc_{s}_class = 'Mobile Only' THEN 'WIRELESS' ELSE fix_{s}_tech END AS fmc_{s}_tech"""


fragment("phone_adjusted", "phone_class", f"""
  SELECT *, {_segment('b')}, {_segment('e')},
    CASE WHEN fix_rejoiner = 1 AND mob_rejoiner = 1 THEN '1. Full Rejoiner'
      WHEN fix_rejoiner = 1 THEN '2. Fixed Rejoiner' WHEN mob_rejoiner = 1 THEN '3. Mobile Rejoiner' END AS fmc_rejoiner,
    CASE WHEN fix_churn_type IS NOT NULL AND fix_churn_type <> '3. Fixed Transfer' THEN
        CASE WHEN mob_churn_flag = '1. Mobile Churner' THEN 'Churner' ELSE 'Fixed Churner' END
      WHEN mob_churn_flag = '1. Mobile Churner' THEN 'Mobile Churner' ELSE 'Non Churner' END AS fmc_churn_flag,
    CASE WHEN fix_churn_type LIKE '1.%' AND coalesce(mob_churn_type, '1.') LIKE '1.%' THEN 'Voluntary Churner'
      WHEN mob_churn_type LIKE '1.%' AND coalesce(fix_churn_type, '3. Fixed Transfer') = '3. Fixed Transfer'
        THEN 'Voluntary Churner'
      WHEN fix_churn_type LIKE '2.%' AND coalesce(mob_churn_type, '2.') LIKE '2.%' THEN 'Involuntary Churner'
      WHEN mob_churn_type LIKE '2.%' AND coalesce(fix_churn_type, '3. Fixed Transfer') = '3. Fixed Transfer'
        THEN 'Involuntary Churner'
      WHEN fix_churn_type LIKE '1.%' OR fix_churn_type LIKE '2.%' THEN 'Mixed Churner'
      WHEN fix_churn_type = '3. Fixed 0P Churner' AND mob_churn_type IS NULL THEN '0P Churner'
      WHEN fix_churn_type = '3. Fixed Transfer' AND mob_churn_type IS NULL THEN 'Fixed Transfer'
      ELSE 'Non Churner' END AS fmc_churn_type
  FROM phone_class""")


@case("phone_fmc_adjusted", "F16", "phone_adjusted", """
  SELECT period, fmc_account, fmc_b_segment, fmc_e_segment, fmc_b_tech, fmc_e_tech, fmc_rejoiner,
    fmc_churn_flag, fmc_churn_type FROM phone_adjusted""")
def _(inputs):
    return T.phone_fmc_adjusted(*_phone_tables(inputs), T.prepaid_phones(inputs)).select(
        "period", "fmc_account", "fmc_b_segment", "fmc_e_segment", "fmc_b_tech", "fmc_e_tech",
        "fmc_rejoiner", "fmc_churn_flag", "fmc_churn_type")


fragment("phone_table", "phone_adjusted", """
  SELECT *, CASE WHEN fmc_rejoiner IN ('2. Fixed Rejoiner', '3. Mobile Rejoiner') AND conv
        THEN '1. FMC Rejoiner' ELSE fmc_rejoiner END AS fmc_rejoiner_final,
    CASE WHEN fmc_churn_flag = 'Churner' THEN 'Total Churner' WHEN fmc_churn_flag = 'Non Churner' THEN NULL
      WHEN fmc_e_segment IS NULL AND fmc_churn_type <> 'Fixed Transfer'
        AND (fmc_churn_flag = 'Fixed Churner' OR fmc_b_segment = 'P1 Mobile') THEN 'Total Churner'
      ELSE 'Partial Churner' END AS partial_total_churn,
    CASE WHEN starts AND coalesce(fix_movement, '4.New Customer') IN ('4.New Customer', '8.Rejoiner-GrossAdd Gap')
          AND coalesce(mob_movement, '4.New Customer') = '4.New Customer'
          AND (fix_movement IS NOT NULL OR mob_movement IS NOT NULL) THEN 'Gross Adds'
      WHEN fix_b_active = 0 AND fix_e_active = 1 AND fix_movement IS NULL AND fix_e_start IS NULL
        THEN 'GrossAdds-Fixed Customer Gap'
      WHEN starts AND returns AND fmc_churn_flag <> 'Non Churner' THEN 'ComeBackToLife-Fixed Customer Gap'
      WHEN starts AND fmc_rejoiner = '1. Full Rejoiner' AND conv THEN '5.1. FMC Rejoiner'
      WHEN starts AND fmc_rejoiner = '2. Fixed Rejoiner' AND NOT conv AND fmc_e_segment IS NOT NULL THEN '5.2. Fixed Rejoiner'
      WHEN starts AND fmc_rejoiner = '3. Mobile Rejoiner' AND NOT conv AND fmc_e_segment IS NOT NULL THEN '5.3. Mobile Rejoiner'
      WHEN stays AND fmc_rejoiner IS NOT NULL THEN '5.4 Near Rejoiner'
      WHEN starts AND returns AND fmc_rejoiner IS NULL THEN 'Gross Adds'
      WHEN starts AND fmc_churn_type = 'Non Churner' AND fix_movement = '7.Transfer Adds' THEN 'Fixed Transfer Adds'
      WHEN fmc_churn_type = 'Fixed Transfer' THEN 'Fixed Transfer Churn'
      WHEN stays AND fmc_b_rgus < fmc_e_rgus THEN 'Upsell'
      WHEN stays AND fmc_b_rgus > fmc_e_rgus THEN 'Downsell'
      WHEN stays AND fmc_b_mrc = fmc_e_mrc THEN 'Maintain'
      WHEN stays AND fmc_b_mrc < fmc_e_mrc THEN 'Upspin'
      WHEN stays THEN 'Downspin'
      WHEN fmc_b_active = 1 AND fmc_churn_flag <> 'Non Churner'
        AND fmc_churn_type IN ('Voluntary Churner', 'Involuntary Churner', 'Mixed Churner') THEN fmc_churn_type
      WHEN fmc_b_active = 1 AND fmc_e_active = 0 AND fix_movement = '6.Null last day'
        AND fmc_churn_flag = 'Non Churner' THEN 'Loss-Fixed Customer Gap' END AS waterfall
  FROM (SELECT *, fmc_b_active = 0 AND fmc_e_active = 1 AS starts, fmc_b_active = 1 AND fmc_e_active = 1 AS stays,
      coalesce(fix_movement, '') = '5.Come Back to Life' OR coalesce(mob_movement, '') = '5.Come Back to Life' AS returns,
      coalesce(regexp_matches(fmc_e_segment, '^[234]P .*FMC$'), false) AS conv
    FROM phone_adjusted) x
  WHERE fmc_b_active + fmc_e_active >= 1 AND mobile_copy = 1""")


@case("phone_fmc_waterfall", "F17", "phone_table", """
  SELECT period, fmc_account, fmc_rejoiner_final, partial_total_churn, waterfall FROM phone_table""")
def _(inputs):
    return T.phone_fmc_table(*_phone_tables(inputs), T.prepaid_phones(inputs)).select(
        "period", "fmc_account", "fmc_rejoiner_final", "partial_total_churn", "waterfall")


fragment("households", "", f"""
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS account, {q('o_orderdate')} AS period,
    min(CASE o_orderpriority WHEN '1-URGENT' THEN '1. Inscrito a Paquete completo'
      WHEN '2-HIGH' THEN '2. Beneficio manual' WHEN '3-MEDIUM' THEN '2. Match_ID' END) AS kind
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL""")


@case("household_convergence", "F18", "closing households service_orders", f"""
  SELECT c.account, c.period, CASE WHEN kind IN ('1. Inscrito a Paquete completo', '2. Beneficio manual') THEN '1.Soft FMC'
      WHEN kind = '2. Match_ID' THEN '2.Near FMC'
      WHEN (vo_nm = 'STANDARD' AND bb_nm = 'LARGE') OR (vo_nm = 'SMALL' AND bb_nm = 'PROMO') THEN '3. Hard FMC'
      ELSE '4.Fixed Only' END AS household_class,
    CASE WHEN kind IN ('1. Inscrito a Paquete completo', '2. Beneficio manual') THEN 'Real FMC'
      WHEN kind = '2. Match_ID' THEN 'Near FMC'
      WHEN (vo_nm = 'STANDARD' AND bb_nm = 'LARGE') OR (vo_nm = 'SMALL' AND bb_nm = 'PROMO') THEN 'Real FMC'
      ELSE 'Fixed Only ' || mix END AS fmc_kind
  FROM closing c LEFT JOIN households h ON h.account = c.account AND h.period = c.period
  WHERE mix <> '0P' AND (age IS NULL OR age <= 90 OR {q('start_dt')} = c.period)
    AND NOT EXISTS (SELECT 1 FROM service_orders o WHERE o.account = c.account AND {q('completed')} = c.period
      AND order_type = 'DESINSTALACION' AND status = 'FINALIZADA')""")
def _(inputs):
    from abonara.operators.churn import finished_disconnects
    snap = inputs.closing.withColumns({"vo_code": F.col("vo_nm"), "bb_code": F.col("bb_nm")})
    priority = F.col("o_orderpriority")
    households = inputs.table("orders").where(F.col("o_orderstatus") == "F").groupBy(
        F.col("o_custkey").cast("string").alias("account"),
        F.trunc("o_orderdate", "quarter").alias("period")).agg(F.min(
            F.when(priority == "1-URGENT", "1. Inscrito a Paquete completo")
            .when(priority == "2-HIGH", "2. Beneficio manual")
            .when(priority == "3-MEDIUM", "2. Match_ID")).alias("kind"))
    return CP.household_fmc(
        snap, finished_disconnects(inputs.service_orders, "quarter"), households,
        (("STANDARD", "LARGE"), ("SMALL", "PROMO")), "quarter").select(
            "account", "period", "household_class", "fmc_kind")
