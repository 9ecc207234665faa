"""Sources, cleaning and sinks."""

from uuid import uuid4

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth, sql_list, sql_pick
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.functions.calendar import day_key_to_date, period_of
from abonara.plans.fixtures import pick
from abonara.session import ensure_checkpoint_dir
from abonara.sources import tables as S
from abonara.sources.mobile import clean_mobile


@case("active_base", "A1", "snap", """
  SELECT account, dt, priority AS cust_type, status AS state FROM snap
  WHERE priority IN ('1-URGENT', '3-MEDIUM', '5-LOW') AND status IN ('O', 'F')""")
def _(inputs):
    snap = inputs.snap.select("account", "dt", F.col("priority").alias("cust_type"),
                              F.col("status").alias("state"))
    return S.active_base(snap, types=("1-URGENT", "3-MEDIUM", "5-LOW"), states=("O", "F"))


@case("active_base_excluding_types", "A1", "snap", """
  SELECT account, dt, priority AS cust_type FROM snap WHERE priority <> '1-URGENT'""")
def _(inputs):
    snap = inputs.snap.select("account", "dt", F.col("priority").alias("cust_type"))
    return S.active_base(snap, types=None, states=None, excluded_types=("1-URGENT",))


RENTS = ("#REF!", "12/3", "NULL", "free")


def _mobile_extract(inputs):
    key = F.col("o_orderkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return inputs.table("orders").select(
        F.when(status == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("extract_day"),
        F.concat(F.lit("7."), F.col("o_custkey").cast("string"), F.lit(",1")).alias("subscriber_id"),
        F.when(status == "P", "#N/D").when(status == "O", "")
        .otherwise(F.col("o_custkey").cast("string")).alias("contract"),
        F.concat(F.lit("8"), F.col("o_custkey").cast("string")).alias("phone"),
        inputs._email(F.col("o_custkey")).alias("email"),
        F.when(priority == "1-URGENT", "Empresas - Pymes").when(priority == "2-HIGH", None)
        .otherwise("Personal").alias("segment"),
        F.when(key % 11 < 4, pick(RENTS, key)).when(key % 11 == 4, None)
        .otherwise(F.concat(F.floor("o_totalprice").cast("string"), F.lit(",5"))).alias("rent"),
        F.when(key % 9 == 0, "#N/D").when(key % 9 == 1, "ARTICULO SIN EQUIPO")
        .when(key % 9 == 2, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("activation_day"),
        pick(("X1", "LA", "X2", "ST2", "X3"), key).alias("plan_id"),
        pick(("Voz", "Datos", "Moviles"), key).alias("use"),
    )


fragment("mobile_extract", "", f"""
  SELECT CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS extract_day,
    '7.' || CAST(o_custkey AS VARCHAR) || ',1' AS subscriber_id,
    CASE o_orderstatus WHEN 'P' THEN '#N/D' WHEN 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS contract,
    '8' || CAST(o_custkey AS VARCHAR) AS phone,
    CASE WHEN o_custkey % 11 = 0 THEN 'NA@GMAIL.COM'
         ELSE 'u' || CAST(o_custkey // 2 AS VARCHAR) || '@mail.example' END AS email,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Empresas - Pymes'
         WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE 'Personal' END AS segment,
    CASE WHEN o_orderkey % 11 < 4 THEN {sql_pick(RENTS, 'o_orderkey')}
         WHEN o_orderkey % 11 = 4 THEN NULL
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ',5' END AS rent,
    CASE o_orderkey % 9 WHEN 0 THEN '#N/D' WHEN 1 THEN 'ARTICULO SIN EQUIPO'
         WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%m/%d/%Y') END AS activation_day,
    {sql_pick(('X1', 'LA', 'X2', 'ST2', 'X3'), 'o_orderkey')} AS plan_id,
    {sql_pick(('Voz', 'Datos', 'Moviles'), 'o_orderkey')} AS use
  FROM orders""")

CLEAN_MOBILE = f"""
  SELECT DISTINCT
    CAST(date_trunc('month', CASE WHEN contains(extract_day, '/')
        THEN try_strptime(extract_day, '%d/%m/%Y') ELSE try_strptime(extract_day, '%Y-%m-%d') END)
      + INTERVAL '1' MONTH AS DATE) AS month,
    replace(replace(subscriber_id, '.', ''), ',', '') AS mobile_account,
    nullif(nullif(contract, ''), '#N/D') AS fixed_contract, phone, email, segment,
    CASE WHEN rent LIKE '%#%' OR rent LIKE '%/%' OR rent = 'NULL' THEN NULL
         ELSE TRY_CAST(replace(coalesce(rent, '0'), ',', '.') AS DOUBLE) END AS mrc,
    CASE WHEN activation_day IN ({sql_list(V.NOT_A_DATE)}) THEN NULL
         WHEN extract_day = '15/03/1998' THEN CAST(try_strptime(activation_day, '%d/%m/%Y') AS DATE)
         ELSE CAST(try_strptime(activation_day, '%m/%d/%Y') AS DATE) END AS start_dt
  FROM mobile_extract
  WHERE segment NOT IN ('Empresas - Empresas', 'Empresas - Pymes')"""


@case("clean_mobile", "A2", "mobile_extract", CLEAN_MOBILE + f"""
    AND plan_id NOT IN ({sql_list(V.EXCLUDED_MOBILE_PLANS)})
    AND use NOT IN ({sql_list(V.EXCLUDED_MOBILE_USES)})""")
def _(inputs):
    return clean_mobile(_mobile_extract(inputs), day_first_extracts=("15/03/1998",))


@case("clean_mobile_all_plans", "A2", "mobile_extract", CLEAN_MOBILE)
def _(inputs):
    return clean_mobile(_mobile_extract(inputs), ("15/03/1998",), exclude_plans=False)


@case("union_orders", "A3", "service_orders install_orders", """
  SELECT order_id, account, order_type, status, start, completed, command, NULL AS channel
  FROM service_orders
  UNION ALL
  SELECT order_id, account, order_type, status, start, completed, NULL, channel FROM install_orders""")
def _(inputs):
    return S.union_orders(inputs.service_orders, inputs.install_orders)


PERIOD_TOTALS = f"""
  SELECT {mth('dt')} AS period, status, count(*) AS accounts, max(bill_amt) AS max_bill
  FROM snap GROUP BY ALL"""


def _period_totals(inputs):
    return inputs.snap.groupBy(period_of(F.col("dt"), "month").alias("period"), "status").agg(
        F.count("*").alias("accounts"), F.max("bill_amt").alias("max_bill"))


@case("saved_periods_read_back", "A4", "snap", PERIOD_TOTALS)
def _(inputs):
    path = f"{ensure_checkpoint_dir(inputs.spark)}/period_totals_{uuid4().hex}"
    S.save_periods(_period_totals(inputs), path)
    return S.read_periods(inputs.spark, path).select("period", "status", "accounts", "max_bill")


@case("stacked_month_tables", "A5", "snap contacts", PERIOD_TOTALS.replace(
    "max_bill", "max_bill, CAST(NULL AS BIGINT) AS contacts") + f"""
  UNION ALL SELECT {mth('day')}, status, NULL, NULL, count(*) FROM contacts GROUP BY ALL""")
def _(inputs):
    contacts = inputs.contacts.groupBy(
        period_of(F.col("day"), "month").alias("period"), "status").agg(F.count("*").alias("contacts"))
    return S.stack_months([_period_totals(inputs), contacts])


@case("decoded_day_keys", "A6", "movement_log", """
  SELECT seq, CAST(strptime(CAST(day_key AS VARCHAR), '%Y%m%d') AS DATE) AS decoded,
    CAST(NULL AS DATE) AS junk FROM movement_log""")
def _(inputs):
    return inputs.movement_log.select(
        "seq", day_key_to_date(F.col("day_key")).alias("decoded"),
        day_key_to_date(F.concat(F.lit("x"), F.col("day_key"))).alias("junk"))


@case("prepaid_base", "A7", "", f"""
  SELECT DISTINCT '8' || CAST(o_custkey AS VARCHAR) AS phone FROM orders
  WHERE {mth('o_orderdate')} = DATE '1997-05-01' AND o_orderstatus = 'O'
    AND o_orderpriority <> '1-URGENT' AND o_totalprice BETWEEN 50000 AND 400000""")
def _(inputs):
    prepaid = inputs.table("orders").select(
        F.concat(F.lit("8"), F.col("o_custkey").cast("string")).alias("subscription_id"),
        period_of(F.to_date("o_orderdate"), "month").alias("dt"),
        F.col("o_orderstatus").alias("cust_state"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "B").otherwise("I").alias("account_type"),
        F.when(F.col("o_totalprice") < 50000, "VI").otherwise("PR").alias("region"),
        F.when(F.col("o_totalprice") > 400000, "S").otherwise("A").alias("subscription_state"))
    return S.prepaid_base(prepaid, F.to_date(F.lit("1997-05-01")))


@case("clean_interactions", "A8", "", f"""
  SELECT event_id AS interaction_id, CAST(ts AS DATE) AS day, {mth('ts')} AS period FROM events
  WHERE event_type <> 'view' AND value >= 5 AND ts < TIMESTAMP '2024-02-01'""")
def _(inputs):
    raw = inputs.table("events").select(
        F.col("event_id").alias("interaction_id"),
        F.when(F.col("event_type") == "view", " ").when(F.col("value") < 5, None)
        .otherwise(F.col("ts").cast("string")).alias("start_text"))
    return S.clean_interactions(raw, F.to_date(F.lit("2024-01-01")), 0).drop("start_text")
