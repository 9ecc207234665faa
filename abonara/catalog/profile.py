"""Row-level derivations."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth, sql_list, sql_pick
from abonara.catalog.registry import case, fragment
from abonara.functions import profile as P
from abonara.functions import values as V
from abonara.functions.calendar import complete_months, period_of
from abonara.operators.checks import product_changes, product_changes_vs_previous
from abonara.plans.fixtures import SALE_CHANNELS, pick

def _arrays():
    return [F.array_compact(F.array(f"{n}_nm")).alias(f"{n}_nms") for n in ("vo", "tv", "bb")]


@case("rgu_flags", "B1", "profiled",
      "SELECT account, dt, rgu_vo, rgu_tv, rgu_bb FROM profiled")
def _(inputs):
    return P.rgu_flags(inputs.snap).select("account", "dt", "rgu_vo", "rgu_tv", "rgu_bb")


@case("rgu_flags_from_arrays", "B1", "snap", """
  SELECT account, dt, CAST(vo_nm IS NOT NULL AS INTEGER) AS rgu_vo,
    CAST(tv_nm IS NOT NULL AS INTEGER) AS rgu_tv, CAST(bb_nm IS NOT NULL AS INTEGER) AS rgu_bb
  FROM snap""")
def _(inputs):
    return P.rgu_flags_from_arrays(inputs.snap.select("account", "dt", *_arrays())).select(
        "account", "dt", "rgu_vo", "rgu_tv", "rgu_bb")


@case("product_mix", "B2", "profiled", """
  SELECT account, dt, mix, nullif(mix, '0P') AS mix_of_quantities,
    CASE mix WHEN '1P' THEN 1 WHEN '2P' THEN 2 WHEN '3P' THEN 3 ELSE 0 END AS mix_quantity
  FROM profiled""")
def _(inputs):
    nullable = lambda c: F.when(F.col(c) > 0, F.col(c))
    return inputs.profiled.select(
        "account", "dt", P.product_mix().alias("mix"),
        P.mix_from_quantities(nullable("rgu_vo"), nullable("rgu_tv"), nullable("rgu_bb"))
        .alias("mix_of_quantities"),
        P.quantity_from_mix(F.col("mix")).alias("mix_quantity"))


@case("bundle_names", "B3", "profiled", """
  SELECT account, dt, CASE rgu_bb * 100 + rgu_tv * 10 + rgu_vo
      WHEN 1 THEN 'VO' WHEN 10 THEN 'TV' WHEN 100 THEN 'BB' WHEN 11 THEN 'TV+VO'
      WHEN 110 THEN 'BB+TV' WHEN 101 THEN 'BB+VO' WHEN 111 THEN 'BB+TV+VO' END AS bundle
  FROM profiled""")
def _(inputs):
    return inputs.profiled.select("account", "dt", P.bundle_name().alias("bundle"))


@case("technology_flags", "B4", "snap", """
  SELECT account, dt,
    CASE WHEN bb_nm LIKE '%PROMO%' OR (tv_nm = 'MEDIUM' AND bb_nm IS NULL) OR vo_nm LIKE '%PROMO%'
         THEN 'FTTH' ELSE 'HFC' END AS tech,
    CASE WHEN bb_nm = 'PROMO' OR (tv_nm = 'MEDIUM' AND bb_nm IS NULL)
         THEN 'FTTH' ELSE 'HFC' END AS tech_of_arrays,
    CASE WHEN bb_nm IS NOT NULL THEN CASE bb_nm WHEN 'PROMO' THEN 'FTTH' ELSE 'COPPER' END
         WHEN tv_nm IS NOT NULL THEN CASE tv_nm WHEN 'MEDIUM' THEN 'HFC' ELSE 'COPPER' END
         WHEN vo_nm = 'SMALL' THEN 'HFC' ELSE 'COPPER' END AS access
  FROM snap""")
def _(inputs):
    medium = lambda c, name, value: F.when(F.col(c) == name, value).otherwise(F.col(c))
    return inputs.snap.select(
        "account", "dt", P.tech_flag("PROMO", "MEDIUM").alias("tech"),
        "vo_nm", "tv_nm", "bb_nm", *_arrays(),
    ).select(
        "account", "dt", "tech", P.tech_flag_from_arrays("PROMO", "MEDIUM").alias("tech_of_arrays"),
        P.access_technology(medium("bb_nm", "PROMO", "FTTH"), medium("tv_nm", "MEDIUM", "HFC"),
                            medium("vo_nm", "SMALL", "HFC")).alias("access"))


@case("province_names", "B5", "dims", f"""
  SELECT account, list_extract([{sql_list(V.PROVINCES.values())}], nation_key) AS province_name
  FROM dims""")
def _(inputs):
    return inputs.dims.select(
        "account", P.province_name(F.col("nation_key").cast("string")).alias("province_name"))


fragment("plan_pairs", "closing", """
  SELECT b.account, e.period,
    coalesce(b.vo_nm, '-') || coalesce(b.tv_nm, '-') || coalesce(b.bb_nm, '-') AS b_plan,
    coalesce(e.vo_nm, '-') || coalesce(e.tv_nm, '-') || coalesce(e.bb_nm, '-') AS e_plan,
    b.status AS b_status, e.status AS e_status
  FROM closing b JOIN closing e
    ON b.account = e.account AND CAST(b.period + INTERVAL '3' MONTH AS DATE) = e.period""")


@case("plan_fingerprints", "B6", "plan_pairs", """
  SELECT account, period, b_plan, e_plan,
    b_plan || CASE WHEN b_status = 'P' THEN '-' WHEN b_status = 'O' THEN '1' ELSE '0' END AS b_plan_full,
    CASE WHEN b_plan = e_plan THEN account END AS unchanged
  FROM plan_pairs""")
def _(inputs):
    side = lambda s: inputs.closing.select(
        "account", "period", P.plan_fingerprint().alias(f"{s}_plan"),
        F.when(F.col("status") == "O", 1).when(F.col("status") == "F", 0).alias(f"{s}_mobile"))
    pairs = side("b").withColumn("period", F.add_months("period", 3)).join(
        side("e"), ["account", "period"])
    return pairs.select(
        "account", "period", "b_plan", "e_plan",
        P.full_plan(F.col("b_plan"), F.col("b_mobile")).alias("b_plan_full"),
        P.unchanged_plan_account(F.col("b_plan"), F.col("e_plan"), F.col("account")).alias("unchanged"))


@case("tenure_segments", "B7", "snap account_firsts", """
  SELECT account, dt, months,
    CASE WHEN months <= 6 THEN 'Early Tenure' WHEN months <= 12 THEN 'Mid Tenure'
         ELSE 'Late Tenure' END AS fixed_segment,
    CASE WHEN days // 30 <= 6 THEN 'Early Tenure' WHEN days // 30 <= 12 THEN 'Mid Tenure'
         ELSE 'Late Tenure' END AS fixed_segment_of_days,
    CASE WHEN months < 6 THEN 'Early Tenure' ELSE 'Late Tenure' END AS mobile_segment
  FROM (SELECT account, dt, CAST(datesub('month', start_dt, dt) AS INTEGER) AS months,
          dt - start_dt AS days FROM snap JOIN account_firsts USING (account)) t""")
def _(inputs):
    months = complete_months(F.col("start_dt"), F.col("dt"))
    return inputs.snap.join(inputs.account_firsts, "account").select(
        "account", "dt", months.alias("months"),
        P.tenure_segment(months).alias("fixed_segment"),
        P.tenure_segment_from_days(F.datediff("dt", "start_dt")).alias("fixed_segment_of_days"),
        P.mobile_tenure_segment(months).alias("mobile_segment"))


@case("complete_months_between", "B7", "", """
  SELECT o_orderkey AS order_id,
    CAST(datesub('month', DATE '1998-01-31', CAST(o_orderdate AS DATE)) AS INTEGER) AS months,
    CAST(datesub('month', CAST(o_orderdate AS DATE), DATE '1998-01-31') AS INTEGER) AS months_back
  FROM orders""")
def _(inputs):
    base, day = F.to_date(F.lit("1998-01-31")), F.to_date("o_orderdate")
    return inputs.table("orders").select(
        F.col("o_orderkey").alias("order_id"), complete_months(base, day).alias("months"),
        complete_months(day, base).alias("months_back"))


@case("mrc_totals", "B8", "snap", """
  SELECT account, dt, round(mrc_vo + mrc_bb + mrc_tv, 0) AS mrc_total, round(mrc_bb, 0) AS mrc_bb
  FROM snap""")
def _(inputs):
    return inputs.snap.select(
        "account", "dt",
        P.mrc_total(F.col("mrc_vo"), F.col("mrc_bb"), F.col("mrc_tv")).alias("mrc_total"),
        F.round("mrc_bb", 0).alias("mrc_bb"))


@case("account_keys", "B9", "", """
  SELECT o_orderkey AS order_id, lpad(right(CAST(o_custkey AS VARCHAR), 10), 10, '0') AS short_key,
    lpad(right('99' || lpad(CAST(o_custkey AS VARCHAR), 12, '5'), 10), 10, '0') AS long_key
  FROM orders""")
def _(inputs):
    text = F.col("o_custkey").cast("string")
    return inputs.table("orders").select(
        F.col("o_orderkey").alias("order_id"), P.last10(F.col("o_custkey")).alias("short_key"),
        P.last10(F.concat(F.lit("99"), F.lpad(text, 12, "5"))).alias("long_key"))


@case("oldest_unpaid_dates", "B10", "snap", "SELECT account, dt, age, unpaid_dt FROM snap")
def _(inputs):
    return inputs.snap.drop("unpaid_dt").select(
        "account", "dt", "age", P.oldest_unpaid(F.col("dt"), F.col("age")).alias("unpaid_dt"))


@case("overdue_ages", "B11 B12", "snap", """
  SELECT account, dt,
    CAST(CASE WHEN bill_dt IS NOT NULL AND status = 'F' THEN age - (due_dt - bill_dt)
         WHEN bill_dt IS NOT NULL THEN age - (dt + 5 - bill_dt)
         ELSE age - (dt + 9 - (dt - 1)) END AS INTEGER) AS overdue,
    CASE WHEN dt < DATE '1998-06-01' THEN age - 7 + 20 ELSE age END AS bridged
  FROM snap""")
def _(inputs):
    bill, dt = F.col("bill_dt"), F.col("dt")
    newest = F.when(F.col("status") == "F", bill)
    return inputs.snap.select(
        "account", "dt",
        P.overdue_age(F.col("age"), [
            (newest, F.col("due_dt")), (bill, F.date_add(dt, 5)),
            (F.date_sub(dt, 1), F.date_add(dt, 9))]).alias("overdue"),
        P.bridged_age(dt, F.col("age") - 7, F.col("age"), "1998-06-01").alias("bridged"))


def _claim_sql(purpose, text):
    whens = []
    for label, patterns in V.CLAIM_PATTERNS:
        likes = " OR ".join(f"{text} LIKE '{p}'" for p in patterns)
        whens.append(f"WHEN {purpose} = 'CLAIM' AND ({likes}) THEN '{label}'")
    return ("CASE " + " ".join(whens) + f" WHEN {purpose} = 'CLAIM' THEN 'other_claims' "
            f"WHEN {purpose} = 'TICKET' THEN 'tech_ticket' "
            f"WHEN {purpose} = 'TRUCKROLL' THEN 'tech_truckroll' END")


@case("claims_in_documents", "B13", "", f"""
  SELECT source, category, kind, count(*) AS texts FROM (
    SELECT source, category, CASE WHEN category = 'billing_claim' THEN 'Billing'
        WHEN category = 'account_info_or_balance_claim' THEN 'Account Info'
        WHEN category = 'retention_claim' THEN 'Retention'
        WHEN category IN ('installation_claim', 'tech_ticket', 'tech_truckroll', 'technical_claim')
          THEN 'Technical' ELSE 'Others' END AS kind
    FROM (SELECT source, {_claim_sql("'CLAIM'", 'lower(text)')} AS category FROM documents) c) k
  GROUP BY ALL""")
def _(inputs):
    category = P.classify_claim(F.lit("CLAIM"), F.col("lowered"))
    return (inputs.table("documents").select("source", F.lower("text").alias("lowered"))
            .select("source", category.alias("category"))
            .withColumn("kind", P.claim_type(F.col("category")))
            .groupBy("source", "category", "kind").agg(F.count("*").alias("texts")))


@case("claims_in_conversations", "B13", "", f"""
  SELECT conv_id, turn, {_claim_sql('purpose', 'info')} AS category FROM (
    SELECT conv_id, turn, CASE role WHEN 'user' THEN 'CLAIM' WHEN 'assistant' THEN 'TICKET'
        ELSE 'TRUCKROLL' END AS purpose,
      replace(lower(coalesce(text, ' ')) || '-' || lower(role), '  ', '') AS info
    FROM conversations) c""")
def _(inputs):
    purpose = (F.when(F.col("role") == "user", "CLAIM").when(F.col("role") == "assistant", "TICKET")
               .otherwise("TRUCKROLL"))
    fields = [F.col("text"), F.col("role")]
    texts = inputs.table("conversations").select(
        "conv_id", "turn", purpose.alias("purpose"),
        P.disposition_text(purpose, fields, fields).alias("info"))
    return texts.select("conv_id", "turn", P.classify_claim(F.col("purpose"), F.col("info")).alias("category"))


@case("technical_texts", "B14", "", f"""
  SELECT doc_id, CASE WHEN ({' OR '.join(f"lower(text) LIKE '{p}'" for p in V.TECH_CALL_INCLUDE)})
      AND NOT ({' OR '.join(f"lower(text) LIKE '{p}'" for p in V.TECH_CALL_EXCLUDE)})
    THEN 'tech_call' END AS kind
  FROM documents""")
def _(inputs):
    lowered = inputs.table("documents").select("doc_id", F.lower("text").alias("lowered"))
    return lowered.select("doc_id", P.classify_technical(F.col("lowered")).alias("kind"))


def _channel_sql(c):
    whens = []
    for label, names, fragments in V.CHANNEL_GROUPS:
        tests = [f"{c} IN ({sql_list(names)})"] + [f"{c} LIKE '%{f}%'" for f in fragments]
        whens.append(f"WHEN {' OR '.join(tests)} THEN '{label}'")
    return "CASE " + " ".join(whens) + " END"


@case("channel_groups", "B15", "gross_adds", f"""
  SELECT sale_id, {_channel_sql('channel')} AS channel_group,
    CASE WHEN {_channel_sql('channel')} LIKE '%D2D%' THEN 'D2D'
         WHEN {_channel_sql('channel')} LIKE '%Digital%' THEN 'Digital'
         ELSE {_channel_sql('channel')} END AS collapsed
  FROM gross_adds""")
def _(inputs):
    group = P.channel_group(F.col("channel"))
    return inputs.gross_adds.select("sale_id", group.alias("channel_group"),
                                    P.collapse_channel(group).alias("collapsed"))


PURPOSES = ("AVERIAS", "SIN SEÑAL", "INFORMACION", "FORMA DE PAGO", "VENTANILLA", "VENTAS", "OTRO")


@case("purpose_lists", "B16", "", f"""
  SELECT event_id, purpose, CAST(purpose IN ({sql_list(V.TECHNICAL_PURPOSES)}) AS INTEGER) AS technical,
    CAST(purpose IN ({sql_list(V.BILLING_PURPOSES)}) AS INTEGER) AS billing,
    CAST(purpose <> 'VENTANILLA' AS INTEGER) AS care,
    CAST(purpose NOT IN ({sql_list(V.EXCLUDED_PURPOSES)}) AS INTEGER) AS counted
  FROM (SELECT event_id, {sql_pick(PURPOSES, 'event_id')} AS purpose FROM events) e""")
def _(inputs):
    purpose = F.col("purpose")
    return inputs.table("events").select("event_id", pick(PURPOSES, F.col("event_id")).alias("purpose")).select(
        "event_id", "purpose",
        P.flag(purpose.isin(*V.TECHNICAL_PURPOSES)).alias("technical"),
        P.flag(purpose.isin(*V.BILLING_PURPOSES)).alias("billing"),
        P.flag(purpose != "VENTANILLA").alias("care"),
        P.flag(~purpose.isin(*V.EXCLUDED_PURPOSES)).alias("counted"))


@case("activity_tags", "B17", "snap", """
  SELECT account, dt, CASE WHEN age >= 90 THEN 'Inactive' WHEN age < 90 THEN 'Active' END AS tag
  FROM snap""")
def _(inputs):
    return inputs.snap.select("account", "dt", P.activity_tag(F.col("age")).alias("tag"))


@case("movement_reasons", "B18", "movement_log", f"""
  SELECT seq, CASE WHEN code = 'BAJAS' AND kind = 'SALIDAS' THEN
      CASE WHEN description IN ({sql_list(V.VOLUNTARY_DESCRIPTIONS)}) THEN '1. Fixed Voluntary Churner'
           WHEN description IN ({sql_list(V.INVOLUNTARY_DESCRIPTIONS)}) THEN '2. Fixed Involuntary Churner'
      END END AS reason
  FROM movement_log""")
def _(inputs):
    return inputs.movement_log.select("seq", P.movement_reason(
        F.col("code"), F.col("kind"), F.col("description")).alias("reason"))


MOBILE_REASON = """CASE WHEN movement = 'Migraciones Out' THEN '2. Mobile Involuntary Churner'
      WHEN movement = 'Bajas' AND 'BAJA INVOLUNTARIA' IN (leave_kind, coalesce(migration_kind, ''))
        THEN '2. Mobile Involuntary Churner'
      WHEN movement = 'Bajas' AND 'BAJA PORTABILIDAD' IN (leave_kind, coalesce(migration_kind, ''))
        THEN '{port}'
      WHEN movement = 'Bajas' AND 'BAJA VOLUNTARIA' IN (leave_kind, coalesce(migration_kind, ''))
        THEN '1. Mobile Voluntary Churner' END"""

fragment("typed_mobile_moves", "mobile_moves", f"""
  SELECT *, {MOBILE_REASON.format(port='1. Mobile Voluntary Churner')} AS churn_type,
    {MOBILE_REASON.format(port='2. Mobile Involuntary Churner')} AS strict_type
  FROM mobile_moves""")


@case("mobile_movement_reasons", "B18", "typed_mobile_moves", """
  SELECT mobile_account, day, movement, churn_type, strict_type FROM typed_mobile_moves""")
def _(inputs):
    columns = [F.col(c) for c in ("movement", "leave_kind", "migration_kind")]
    return inputs.mobile_moves.select(
        "mobile_account", "day", "movement",
        P.mobile_movement_reason(*columns).alias("churn_type"),
        P.mobile_movement_reason(*columns, port_out_involuntary=True).alias("strict_type"))


@case("product_changes", "B19", "snap", """
  SELECT account, dt, CAST(vo_nm <> p_vo OR tv_nm <> p_tv OR bb_nm <> p_bb AS BOOLEAN) AS changed,
    CASE WHEN bb_nm <> p_bb OR p_bb IS NULL THEN bb_nm END AS new_bb,
    CASE WHEN tv_nm <> p_tv OR p_tv IS NULL THEN tv_nm END AS new_tv,
    CASE WHEN vo_nm <> p_vo OR p_vo IS NULL THEN vo_nm END AS new_vo
  FROM (SELECT *, lag(vo_nm) OVER w AS p_vo, lag(tv_nm) OVER w AS p_tv, lag(bb_nm) OVER w AS p_bb
        FROM snap WINDOW w AS (PARTITION BY account ORDER BY dt)) p""")
def _(inputs):
    return product_changes_vs_previous(inputs.snap).select(
        "account", "dt", "changed", "new_bb", "new_tv", "new_vo")


@case("next_period_product_changes", "B19", "closing", """
  SELECT e.account, e.period, coalesce(e.vo_nm <> b.vo_nm OR e.tv_nm <> b.tv_nm
      OR e.bb_nm <> b.bb_nm, false) AS changed
  FROM closing e JOIN closing b
    ON e.account = b.account AND e.period = CAST(b.period + INTERVAL '3' MONTH AS DATE)""")
def _(inputs):
    return product_changes(inputs.closing, grain="quarter", day="period").select(
        "account", "period", "changed")
