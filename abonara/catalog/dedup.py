"""First, last, repair and dedup operators."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth, q
from abonara.catalog.registry import case, fragment
from abonara.functions.calendar import period_of
from abonara.operators import dedup as D


@case("first_and_last_attributes", "C1", "snap", """
  SELECT DISTINCT account, first_value(inst_dt) OVER up AS first_inst, first_value(age) OVER up AS first_age,
    first_value(inst_dt) OVER down AS last_inst, first_value(age) OVER down AS last_age,
    min(dt) OVER (PARTITION BY account) AS first_seen
  FROM snap WINDOW up AS (PARTITION BY account ORDER BY dt), down AS (PARTITION BY account ORDER BY dt DESC)""")
def _(inputs):
    first = D.first_by(inputs.snap, ["account"], ["dt"], {
        "first_inst": F.col("inst_dt"), "first_age": F.col("age"), "first_seen": F.col("dt")})
    last = D.last_by(inputs.snap, ["account"], ["dt"], {
        "last_inst": F.col("inst_dt"), "last_age": F.col("age")})
    return first.join(last, "account")


@case("first_known_ages", "C2", "snap", f"""
  SELECT account, {q('dt')} AS period,
    arg_min(age, dt) FILTER (WHERE age IS NOT NULL) AS first_known,
    arg_max(age, dt) FILTER (WHERE age IS NOT NULL) AS last_known
  FROM snap GROUP BY ALL""")
def _(inputs):
    return inputs.snap.groupBy("account", period_of(F.col("dt"), "quarter").alias("period")).agg(
        D.first_non_null(F.col("age"), F.col("dt")).alias("first_known"),
        D.last_non_null(F.col("age"), F.col("dt")).alias("last_known"))


@case("repaired_ages", "C3", "repaired", """
  SELECT account, dt, age, prev_age, next_age, is_jump, age_fix FROM repaired""")
def _(inputs):
    return D.repair_age(inputs.snap.select("account", "dt", "age"))


@case("repaired_ages_isolated_to_null", "C3", "repaired_strict", """
  SELECT account, dt, is_jump, age_fix FROM repaired_strict""")
def _(inputs):
    repaired = D.repair_age(inputs.snap.select("account", "dt", "age"),
                            isolated_to_null=True, unique_days=False)
    return repaired.select("account", "dt", "is_jump", "age_fix")


fragment("deduped", "contacts", """
  SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY account, day, purpose
      ORDER BY start DESC, interaction_id DESC) AS nth FROM contacts) c WHERE nth = 1""")


@case("latest_contact_per_day_and_purpose", "C4", "deduped",
      "SELECT interaction_id, account, day, purpose, status FROM deduped")
def _(inputs):
    return D.dedup_interactions(inputs.contacts).select(
        "interaction_id", "account", "day", "purpose", "status")


@case("first_contact_of_repeats", "C5", "contacts", """
  SELECT min(interaction_id) AS interaction_id, account, day, channel, agent, purpose
  FROM contacts GROUP BY account, day, channel, agent, purpose""")
def _(inputs):
    return D.dedup_first_id(inputs.contacts).select(
        "interaction_id", "account", "day", "channel", "agent", "purpose")


@case("one_row_per_account", "C6", "snap", """
  SELECT account, dt, order_id, bill_amt FROM (SELECT *, row_number() OVER (PARTITION BY account
      ORDER BY bill_amt DESC, order_id) AS nth FROM snap) s WHERE nth = 1""")
def _(inputs):
    return D.keep_one(inputs.snap, ["account"], [F.desc("bill_amt"), F.asc("order_id")]).select(
        "account", "dt", "order_id", "bill_amt")


@case("densest_entry_days", "C7", "account_firsts", f"""
  SELECT period, first_day, accounts FROM (
    SELECT {mth('start_dt')} AS period, start_dt AS first_day, count(*) AS accounts,
      row_number() OVER (PARTITION BY {mth('start_dt')} ORDER BY count(*) DESC, start_dt) AS nth
    FROM account_firsts GROUP BY start_dt) d WHERE nth = 1""")
def _(inputs):
    return D.densest_entry_day(inputs.account_firsts.withColumnRenamed("start_dt", "first_day"))


@case("orders_sharing_a_quarter", "C8", "snap", f"""
  SELECT account, dt, copies, bill_amt / copies AS share FROM (
    SELECT *, count(*) OVER (PARTITION BY account, {q('dt')}) AS copies FROM snap) c""")
def _(inputs):
    rows = inputs.snap.withColumn("period", period_of(F.col("dt"), "quarter"))
    return D.attach_multiplicity(rows, ["account", "period"]).select(
        "account", "dt", "copies", (F.col("bill_amt") / F.col("copies")).alias("share"))


@case("ranked_pairs", "C9", "", """
  WITH pairs AS (SELECT DISTINCT DATE '2024-01-01' AS period, CAST(o_custkey AS VARCHAR) AS fixed_account,
      o_orderpriority || o_orderstatus AS mobile_account FROM orders)
  SELECT period, fixed_account, mobile_account, CAST(left_rank AS INTEGER) AS left_rank,
    CAST(right_rank AS INTEGER) AS right_rank
  FROM (SELECT *,
      row_number() OVER (PARTITION BY fixed_account ORDER BY mobile_account DESC) AS left_rank,
      row_number() OVER (PARTITION BY mobile_account ORDER BY fixed_account DESC) AS right_rank
    FROM pairs) r WHERE left_rank = 1 AND right_rank <= 2""")
def _(inputs):
    pairs = inputs.table("orders").select(
        F.to_date(F.lit("2024-01-01")).alias("period"),
        F.col("o_custkey").cast("string").alias("fixed_account"),
        F.concat("o_orderpriority", "o_orderstatus").alias("mobile_account")).distinct()
    return D.rank_pairs(pairs)
