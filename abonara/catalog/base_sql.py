"""SQL of the shared inputs (see ``plans.fixtures`` for the Spark side)."""

from abonara.catalog.registry import fragment
from abonara.functions import values as V


def sql_list(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


def sql_pick(options, number: str) -> str:
    return f"list_extract([{sql_list(options)}], CAST(({number}) % {len(options)} AS INTEGER) + 1)"


def q(date: str) -> str:
    """Quarter start as DATE."""
    return f"CAST(date_trunc('quarter', {date}) AS DATE)"


def mth(date: str) -> str:
    return f"CAST(date_trunc('month', {date}) AS DATE)"


def plus(date: str, months: int) -> str:
    return f"CAST({date} + INTERVAL '{months}' MONTH AS DATE)"


from abonara.plans.fixtures import LOG_DESCRIPTIONS, ORDER_COMMANDS, SALE_CHANNELS  # noqa: E402

fragment("order_lines", "", """
  SELECT l_orderkey, CAST(max(l_quantity * 2) AS INTEGER) AS double_quantity,
    max(l_linenumber) AS lines,
    min(p_type) FILTER (WHERE p_type IN ('STANDARD', 'SMALL')) AS vo_nm,
    max(l_extendedprice) FILTER (WHERE p_type IN ('STANDARD', 'SMALL')) AS mrc_vo,
    min(p_type) FILTER (WHERE p_type IN ('ECONOMY', 'MEDIUM')) AS tv_nm,
    max(l_extendedprice) FILTER (WHERE p_type IN ('ECONOMY', 'MEDIUM')) AS mrc_tv,
    min(p_type) FILTER (WHERE p_type IN ('PROMO', 'LARGE')) AS bb_nm,
    max(l_extendedprice) FILTER (WHERE p_type IN ('PROMO', 'LARGE')) AS mrc_bb
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")

fragment("snap", "order_lines", """
  SELECT account, dt, order_id, status, priority, vo_nm, tv_nm, bb_nm, mrc_vo, mrc_tv, mrc_bb,
    bill_amt, phone, age, bill_dt, due_dt, inst_dt, last_pay_dt,
    CASE WHEN age IS NULL THEN DATE '1900-01-01' ELSE CAST(dt - age AS DATE) END AS unpaid_dt
  FROM (
    SELECT CAST(o_custkey AS VARCHAR) AS account, CAST(o_orderdate AS DATE) AS dt,
      o_orderkey AS order_id, o_orderstatus AS status, o_orderpriority AS priority, vo_nm,
      CASE WHEN tv_nm IS NULL AND o_orderstatus = 'O' THEN '' ELSE tv_nm END AS tv_nm, bb_nm,
      mrc_vo, mrc_tv, mrc_bb, o_totalprice AS bill_amt, '2' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS phone,
      CASE WHEN o_orderstatus <> 'P' THEN double_quantity END AS age,
      CAST(o_orderdate AS DATE) - lines AS bill_dt,
      CAST(o_orderdate AS DATE) - lines + 15 AS due_dt,
      CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INTEGER) AS inst_dt,
      CAST(o_orderdate AS DATE) - lines * 5 AS last_pay_dt,
      row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                         ORDER BY o_orderkey DESC) AS nth
    FROM orders LEFT JOIN order_lines ON l_orderkey = o_orderkey) r
  WHERE nth = 1""")

fragment("profiled", "snap", """
  SELECT *, CAST(rgu_vo + rgu_tv + rgu_bb AS INTEGER) AS num_rgus,
    CAST(rgu_vo + rgu_tv + rgu_bb AS VARCHAR) || 'P' AS mix,
    CASE WHEN bb_nm = 'PROMO' OR (tv_nm = 'MEDIUM' AND bb_nm IS NULL) THEN 'FTTH' ELSE 'HFC' END AS tech,
    CASE rgu_bb * 100 + rgu_tv * 10 + rgu_vo WHEN 1 THEN 'VO' WHEN 10 THEN 'TV' WHEN 100 THEN 'BB' WHEN 11 THEN 'TV+VO'
      WHEN 110 THEN 'BB+TV' WHEN 101 THEN 'BB+VO' WHEN 111 THEN 'BB+TV+VO' END AS bundle,
    round(mrc_vo + mrc_bb + mrc_tv, 0) AS charge
  FROM (SELECT *,
      CASE WHEN coalesce(vo_nm, '') = '' THEN 0 ELSE 1 END AS rgu_vo,
      CASE WHEN coalesce(tv_nm, '') = '' THEN 0 ELSE 1 END AS rgu_tv,
      CASE WHEN coalesce(bb_nm, '') = '' THEN 0 ELSE 1 END AS rgu_bb
    FROM snap) f""")

REPAIR = """
  SELECT *, CASE WHEN is_jump = 1 THEN prev_age + 1
       WHEN age IS NULL AND next_age = prev_age + 2 THEN prev_age + 1{extra} ELSE age END AS age_fix
  FROM (SELECT *, CASE WHEN (age - prev_age > 2 AND age - next_age > 2)
            OR (age - prev_age < -2 AND age - next_age < -2) THEN 1 ELSE 0 END AS is_jump
    FROM (SELECT *, lag(age) OVER w AS prev_age, lead(age) OVER w AS next_age
          FROM snap WINDOW w AS (PARTITION BY account ORDER BY dt)) n) j"""
fragment("repaired", "snap", REPAIR.format(extra=""))
fragment("repaired_strict", "snap", REPAIR.format(
    extra=" WHEN prev_age IS NULL AND next_age IS NULL THEN NULL"))

fragment("account_firsts", "snap", """
  SELECT account, min(dt) AS start_dt, max(inst_dt) AS max_inst_dt FROM snap GROUP BY account""")

fragment("closing", "profiled repaired account_firsts", f"""
  SELECT c.* EXCLUDE (nth), start_dt, max_inst_dt,
    CAST(datesub('month', start_dt, dt) AS INTEGER) AS tenure
  FROM (SELECT p.*, age_fix, {q('dt')} AS period,
          row_number() OVER (PARTITION BY account, {q('dt')} ORDER BY dt DESC) AS nth
        FROM profiled p JOIN (SELECT account, dt, age_fix FROM repaired) r USING (account, dt)) c
  JOIN account_firsts USING (account) WHERE nth = 1""")

fragment("service_orders", "", f"""
  SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS account,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'DESINSTALACION'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'INSTALACION' ELSE 'TRASLADO' END AS order_type,
    CASE WHEN o_orderstatus = 'F' THEN 'FINALIZADA' ELSE 'PENDIENTE' END AS status,
    {sql_pick(ORDER_COMMANDS, 'o_orderkey')} AS command,
    CAST(o_orderdate AS DATE) AS start,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS completed
  FROM orders""")

fragment("movement_log", "", f"""
  SELECT o_custkey AS contract, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key,
    CAST(o_orderdate AS DATE) AS day, o_orderkey AS seq,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'BAJAS'
         WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'CAMBIO PRODUCTO'
         ELSE 'ALTAS' END AS code,
    CASE WHEN o_orderstatus = 'F' THEN 'SALIDAS' ELSE 'ENTRADAS' END AS kind,
    {sql_pick(LOG_DESCRIPTIONS, 'o_orderkey')} AS description
  FROM orders""")

EMAIL = """CASE WHEN ({0}) % 11 = 0 THEN 'NA@GMAIL.COM'
    ELSE 'u' || CAST(({0}) // 2 AS VARCHAR) || '@mail.example' END"""

fragment("mobile_closing", "", f"""
  SELECT * EXCLUDE (nth) FROM (
    SELECT '7' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS mobile_account,
      {q('o_orderdate')} AS period, CAST(o_orderdate AS DATE) AS dt, o_orderkey AS order_id,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS fixed_contract,
      CASE WHEN o_orderstatus <> 'O' THEN round(o_totalprice / 100000, 0) END AS mrc,
      CAST(o_orderdate AS DATE) - CAST(o_orderkey % 400 AS INTEGER) AS start_dt,
      {EMAIL.format('o_custkey')} AS email,
      row_number() OVER (PARTITION BY o_custkey, {q('o_orderdate')}
                         ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) m
  WHERE nth = 1""")

fragment("fixed_emails", "", f"""
  SELECT CAST(c_custkey AS VARCHAR) AS account, {EMAIL.format('c_custkey + 1')} AS email
  FROM customer""")

fragment("mobile_moves", "", f"""
  SELECT '7' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS mobile_account,
    CAST(o_orderdate AS DATE) AS day,
    {sql_pick((V.MOBILE_LEAVE, V.MOBILE_LEAVE, V.MOBILE_OUT_MIGRATION, 'Altas'), 'o_orderkey')} AS movement,
    {sql_pick((V.MOBILE_INVOLUNTARY, V.MOBILE_PORT_OUT, V.MOBILE_VOLUNTARY, 'OTRA'), 'o_orderkey // 4')} AS leave_kind,
    CASE WHEN o_orderstatus = 'P' THEN 'BAJA VOLUNTARIA' END AS migration_kind
  FROM orders""")

fragment("gross_adds", "", f"""
  SELECT CAST(o_custkey AS VARCHAR) AS account,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sales_day,
    o_orderkey AS sale_id, {sql_pick(SALE_CHANNELS, 'o_orderkey')} AS channel,
    o_orderpriority AS seller, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS rgus_sold_text
  FROM orders""")

fragment("contacts", "", """
  SELECT event_id AS interaction_id, CAST(user_id AS VARCHAR) AS account, ts AS start,
    CAST(ts AS DATE) AS day, event_type AS purpose,
    CASE event_id % 10 WHEN 0 THEN 'ANULADA' WHEN 5 THEN 'CANCELADA' ELSE 'CERRADA' END AS status,
    regexp_extract(props, '[0-9]+', 0) AS channel, CAST(floor(value / 100) AS INTEGER) AS agent
  FROM events""")

fragment("bills", "", """
  SELECT CAST(user_id AS VARCHAR) AS account, CAST(ts AS DATE) AS dt, event_id AS row_id,
    CASE WHEN value >= 20 THEN CAST(ts AS DATE) END AS bill_dt, round(value, 2) AS mrc,
    CAST(event_id % 4 AS INTEGER) AS mix_qty,
    CASE WHEN event_id % 4 >= 1 THEN 'bb-' || CAST(event_id % 3 AS VARCHAR) END AS bb_nm,
    CASE WHEN event_id % 4 >= 2 THEN 'tv-' || CAST(event_id % 3 AS VARCHAR) END AS tv_nm,
    CASE WHEN event_id % 4 >= 3 THEN 'vo-' || CAST(event_id % 3 AS VARCHAR) END AS vo_nm
  FROM events WHERE event_type = 'signup'""")

fragment("payments", "", """
  SELECT event_id AS payment_id, CAST(user_id AS VARCHAR) AS account, CAST(ts AS DATE) AS dt,
    round(value, 2) AS amount
  FROM events WHERE event_type = 'purchase'""")

fragment("install_orders", "", f"""
  SELECT event_id AS order_id, CAST(user_id AS VARCHAR) AS account, 'INSTALACION' AS order_type,
    CASE WHEN event_id % 10 = 0 THEN 'CANCELADA' ELSE 'FINALIZADA' END AS status,
    CAST(ts AS DATE) AS start,
    CAST(ts AS DATE) + CAST(floor(value / 25) AS INTEGER) AS completed,
    {sql_pick(SALE_CHANNELS, 'event_id')} AS channel
  FROM events WHERE event_type = 'signup'""")

fragment("usage", "", """
  SELECT CAST(user_id AS VARCHAR) AS account, CAST(ts AS DATE) AS dt,
    CAST(max(round(value, 0)) AS INTEGER) AS age, max(round(value, 2)) AS mrc,
    count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'error') AS errors
  FROM events GROUP BY ALL""")

fragment("dims", "", """
  SELECT CAST(c_custkey AS VARCHAR) AS account, c_mktsegment AS segment, n_name AS province,
    c_nationkey AS nation_key
  FROM customer JOIN nation ON n_nationkey = c_nationkey""")
