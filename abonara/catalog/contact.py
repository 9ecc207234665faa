"""Contact and experience drivers."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import mth, q, sql_list
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.operators import contact as I
from abonara.plans import drivers as P
from abonara.plans import tables as T
from abonara.sources.tables import read_table


def wk(d):
    return f"CAST(date_trunc('week', {d}) AS DATE)"


fragment("sold", "bills", "SELECT account, min(dt) AS sale_day FROM bills GROUP BY account")
fragment("early_contacts", "sold deduped", f"""
  SELECT c.account, {wk('sale_day')} AS period, count(*) AS contacts, min(day) AS first_contact
  FROM deduped c JOIN sold s ON s.account = c.account AND day BETWEEN sale_day AND sale_day + 3
  WHERE purpose <> 'view' AND status <> 'ANULADA' GROUP BY 1, 2""")


@case("early_contacts", "I1", "early_contacts", "SELECT * FROM early_contacts")
def _(inputs):
    return I.early_contact(P.sales(inputs), P.care_contacts(inputs), 3, "week")


@case("contacts_up_to_21_days_after_sale", "I1", "sold deduped", f"""
  SELECT c.account, {wk('sale_day')} AS period, count(*) AS contacts, min(day) AS first_contact
  FROM deduped c JOIN sold s ON s.account = c.account AND day - sale_day <= 21
  WHERE purpose <> 'view' AND status <> 'ANULADA' GROUP BY 1, 2""")
def _(inputs):
    return I.early_contact(P.sales(inputs), P.care_contacts(inputs), 21, "week", lower=None)


fragment("tickets", "deduped", "SELECT * FROM deduped WHERE purpose = 'error' AND status <> 'ANULADA'")
fragment("early_tickets", "sold tickets", f"""
  SELECT t.account, {wk('sale_day')} AS period, count(*) AS contacts, min(day) AS first_contact
  FROM tickets t JOIN sold s ON s.account = t.account AND day >= sale_day AND (day - sale_day) // 7 <= 1
  GROUP BY 1, 2""")


@case("early_tickets", "I2", "early_tickets", "SELECT * FROM early_tickets")
def _(inputs):
    return I.early_ticket(P.sales(inputs), P.tickets(inputs), 1, "week")


fragment("claims", "deduped", f"""
  SELECT account, {wk('day')} AS period, count(DISTINCT interaction_id) AS claims FROM deduped
  WHERE purpose = 'purchase' AND status <> 'ANULADA' GROUP BY 1, 2""")


@case("bill_claims", "I3 B16", "claims", "SELECT * FROM claims")
def _(inputs):
    return I.bill_claims(P.contacts(inputs), P.BILLING, "week")


@case("bill_shocks", "I4", "fmc_table", """
  SELECT period, final_account, CASE WHEN b_plan_full = e_plan_full THEN fixed_account END AS no_plan_change,
    CASE WHEN abs(mrc_change) > b_total_mrc * 0.05 AND b_plan = e_plan AND b_plan_full = e_plan_full
      THEN fixed_account END AS bill_shock
  FROM fmc_table""")
def _(inputs):
    return I.bill_shock(T.fmc_table(inputs)).select("period", "final_account", "no_plan_change", "bill_shock")


@case("charge_increases_between_periods", "I4", "fixed_table", """
  SELECT n.period, n.account,
    CASE WHEN n.e_bill_amt / p.b_bill_amt > 1.05 THEN n.account END AS mrc_increase,
    CASE WHEN n.e_bill_amt / p.b_bill_amt <= 1.05 THEN n.account END AS no_plan_change
  FROM fixed_table n JOIN fixed_table p
    ON p.account = n.account AND CAST(p.period + INTERVAL '3' MONTH AS DATE) = n.period
  WHERE p.b_age < 85 AND n.e_age < 85""")
def _(inputs):
    return I.mrc_increase(T.fixed_table(inputs), grain="quarter")


@case("relative_charge_changes", "I4", "snap", """
  SELECT account, dt, (bill_amt - p_bill) / p_bill AS change,
    CASE WHEN abs((bill_amt - p_bill) / p_bill) > 0.05 THEN account END AS mrc_change_flag
  FROM (SELECT *, lag(bill_amt) OVER w AS p_bill, lag(vo_nm) OVER w AS p_vo, lag(tv_nm) OVER w AS p_tv,
          lag(bb_nm) OVER w AS p_bb FROM snap WINDOW w AS (PARTITION BY account ORDER BY dt)) s
  WHERE vo_nm = p_vo AND tv_nm = p_tv AND bb_nm = p_bb""")
def _(inputs):
    return I.relative_mrc_change(inputs.snap)


fragment("long_installs", "install_orders", f"""
  SELECT account, {wk('completed')} AS period, CAST(max(completed - start) AS INTEGER) AS days_taken
  FROM install_orders WHERE status = 'FINALIZADA' AND completed - start > 5 GROUP BY 1, 2""")


@case("long_installs", "I5", "long_installs", "SELECT * FROM long_installs")
def _(inputs):
    return I.long_install(inputs.install_orders, 5, "week")


@case("long_installs_over_six_days", "I5", "service_orders", f"""
  SELECT account, {q('completed')} AS period, CAST(max(completed - start) AS INTEGER) AS days_taken
  FROM service_orders WHERE order_type = 'INSTALACION' AND status = 'FINALIZADA'
    AND completed - start > 6 GROUP BY 1, 2""")
def _(inputs):
    return I.long_install(inputs.service_orders, 6, "quarter")


@case("mounting_bills", "I6", "repaired", f"""
  SELECT account, {q('dt')} AS period, max(CASE WHEN age_fix = 60 THEN 1 ELSE 0 END) AS mounting_bill
  FROM repaired GROUP BY 1, 2""")
def _(inputs):
    return I.mounting_bill(T.repaired(inputs), 60, "quarter")


@case("mounting_bills_by_pair", "I7", "closing", """
  SELECT e.account, e.period, CAST(b.account IS NOT NULL AS INTEGER) AS mounting_bill
  FROM closing e LEFT JOIN closing b ON b.account = e.account AND b.unpaid_dt = e.unpaid_dt
    AND CAST(b.period + INTERVAL '3' MONTH AS DATE) = e.period AND e.bill_dt IS NOT NULL AND e.age IS NOT NULL""")
def _(inputs):
    return I.mounting_bill_pair(inputs.closing, "quarter")


fragment("callers", "deduped", f"""
  SELECT l.account, l.period, last_day, CAST(count(DISTINCT interaction_id) AS BIGINT) AS contacts
  FROM (SELECT account, {wk('day')} AS period, max(day) AS last_day FROM deduped
        WHERE status <> 'ANULADA' AND purpose <> 'view' GROUP BY 1, 2) l
  JOIN deduped d ON d.account = l.account AND d.day BETWEEN l.last_day - 7 AND l.last_day GROUP BY ALL""")


@case("repeat_callers", "I8", "callers", """
  SELECT *, CASE WHEN contacts = 1 THEN account END AS one_call,
    CASE WHEN contacts = 2 THEN account END AS two_calls,
    CASE WHEN contacts >= 3 THEN account END AS more_calls FROM callers""")
def _(inputs):
    return I.repeat_callers(P.contacts(inputs), 7, P.EXCLUDED, "week")


fragment("tiers", "tickets", f"""
  SELECT m.account, m.period, CAST(count(DISTINCT interaction_id) AS BIGINT) AS tickets,
    CASE count(DISTINCT interaction_id) WHEN 1 THEN '1' WHEN 2 THEN '2' ELSE '3+' END AS tier
  FROM (SELECT account, {wk('day')} AS period, max(day) AS last_day FROM tickets GROUP BY 1, 2) m
  JOIN tickets t ON t.account = m.account AND t.day BETWEEN last_day - 7 AND last_day GROUP BY m.account, m.period""")


@case("ticket_tiers", "I9", "tiers", "SELECT * FROM tiers")
def _(inputs):
    return I.ticket_tiers(P.tickets(inputs), 7, "week")


fragment("failed", "deduped", f"""
  SELECT account, {wk('day')} AS period, count(*) AS failed FROM deduped
  WHERE status IN ('CANCELADA', 'ANULADA') GROUP BY 1, 2""")


@case("failed_visits", "I10", "failed", "SELECT * FROM failed")
def _(inputs):
    return I.failed_visits(P.contacts(inputs), "week")


fragment("density", "deduped", f"""
  SELECT account, {wk('day')} AS period, count(DISTINCT interaction_id) AS tickets FROM deduped
  WHERE purpose = 'error' GROUP BY 1, 2""")


@case("ticket_density", "I11", "density", "SELECT * FROM density")
def _(inputs):
    return I.ticket_density(P.contacts(inputs), P.TECHNICAL, "week")


PURPOSE_TEXT = {"error": "Hsd Problem", "click": "Slow Service", "purchase": "Billing",
                "signup": "Cust First Call", "view": "Work Order Status"}


def _tech_sql(text):
    inc = " OR ".join(f"lower({text}) LIKE '{p}'" for p in V.TECH_CALL_INCLUDE)
    exc = " OR ".join(f"lower({text}) LIKE '{p}'" for p in V.TECH_CALL_EXCLUDE)
    return f"CASE WHEN ({inc}) AND NOT ({exc}) THEN 'tech_call' END"


@case("truck_rolls_and_contacts", "I12 B14 C5", "contacts", f"""
  SELECT coalesce(c.account, t.account) AS account, coalesce(c.day, t.day) AS day, interaction_id, job, jobs,
    CASE WHEN job IS NOT NULL THEN 'truckroll' ELSE {_tech_sql('purpose_text')} END AS contact_kind
  FROM (SELECT min(interaction_id) AS interaction_id, account, day, CASE purpose
      {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PURPOSE_TEXT.items())} END AS purpose_text
    FROM contacts WHERE purpose NOT IN ('view', 'signup')
    GROUP BY account, day, channel, agent, purpose) c
  FULL JOIN (SELECT account, day, min(interaction_id) AS job, count(*) AS jobs FROM contacts
    WHERE purpose = 'signup' GROUP BY 1, 2) t ON t.account = c.account AND t.day = c.day""")
def _(inputs):
    from abonara.operators.dedup import dedup_first_id
    pairs = [F.lit(x) for item in PURPOSE_TEXT.items() for x in item]
    texts = dedup_first_id(inputs.contacts).withColumn(
        "purpose_text", F.create_map(*pairs)[F.col("purpose")]).where(
        ~F.col("purpose_text").isin("Work Order Status", "Cust First Call"))
    jobs = inputs.contacts.where(F.col("purpose") == "signup").select(
        "account", "day", F.col("interaction_id").alias("job"))
    return I.truckroll_match(texts.select("account", "day", "interaction_id", "purpose_text"), jobs).select(
        "account", "day", "interaction_id", "job", "jobs", "contact_kind")


fragment("weekly", "usage", f"""
  SELECT account, {wk('dt')} AS period, CAST((sum(views) > 0)::INTEGER + (sum(clicks) > 0)::INTEGER
    + (sum(errors) > 0)::INTEGER AS INTEGER) AS rgus, max(mrc) AS mrc, max(age) AS age
  FROM usage GROUP BY 1, 2""")
fragment("week_base", "weekly dims", """
  SELECT w.account, w.account AS fixed_account, w.period, segment, province, w.rgus, p.mrc AS b_total_mrc,
    round(w.mrc - p.mrc, 2) AS mrc_change, CAST(p.age // 50 AS VARCHAR) AS b_plan,
    CAST(w.age // 50 AS VARCHAR) AS e_plan, CAST(p.age // 50 AS VARCHAR) AS b_plan_full,
    CAST(w.age // 50 AS VARCHAR) AS e_plan_full,
    CASE WHEN w.period >= DATE '2024-01-29' OR n.account IS NOT NULL THEN 'Non Churner'
         ELSE 'Fixed Churner' END AS final_churn_flag
  FROM weekly w JOIN dims d ON d.account = w.account
  LEFT JOIN weekly p ON p.account = w.account AND p.period + 7 = w.period
  LEFT JOIN weekly n ON n.account = w.account AND n.period = w.period + 7""")
fragment("shocked", "week_base", """
  SELECT *, CASE WHEN b_plan_full = e_plan_full THEN account END AS no_plan_change,
    CASE WHEN b_plan_full = e_plan_full AND abs(mrc_change) > b_total_mrc * 0.05 THEN account END AS bill_shock
  FROM week_base""")
fragment("soft", "sold usage", f"""
  SELECT c.account, c.period FROM (SELECT {wk('sale_day')} AS period, account, dense_rank() OVER (
      PARTITION BY {wk('sale_day')} ORDER BY n DESC, sale_day) AS nth
    FROM (SELECT *, count(*) OVER (PARTITION BY sale_day) AS n FROM sold) x) c
  JOIN usage u ON u.account = c.account WHERE nth = 1
  GROUP BY 1, 2 HAVING max(age) BETWEEN 26 AND 89""")
fragment("mounted", "usage", f"SELECT DISTINCT account, {wk('dt')} AS period FROM usage WHERE age = 60")


def _mark(table):
    return f"CASE WHEN EXISTS (SELECT 1 FROM {table} x WHERE x.account = b.account AND x.period = b.period) THEN b.account END"


fragment("drivers", "shocked sold soft long_installs early_contacts early_tickets claims mounted", f"""
  SELECT b.*, (SELECT s.account FROM sold s WHERE s.account = b.account AND {wk('sale_day')} = b.period) AS sales,
    {_mark('soft')} AS soft_dx, {_mark('long_installs')} AS long_install, {_mark('early_contacts')} AS early_contact,
    {_mark('early_tickets')} AS early_ticket, {_mark('claims')} AS bill_claim, {_mark('mounted')} AS mounting_bill
  FROM shocked b""")


@case("driver_flags", "I1 I2 I3 I4 I5 I6 G14", "drivers", "SELECT * FROM drivers")
def _(inputs):
    return P.driver_table(inputs)


def _counts(flags):
    return ", ".join(f"count(DISTINCT {f}) AS {f}" for f in flags)


fragment("driver_summary", "drivers", f"""
  SELECT period, segment, count(DISTINCT account) AS active_base, {_counts(P.DRIVER_FLAGS)}
  FROM drivers WHERE final_churn_flag NOT IN ('Fixed Churner', 'Full Churner') GROUP BY period, segment""")


@case("driver_summary", "I13", "driver_summary", "SELECT * FROM driver_summary")
def _(inputs):
    return P.driver_summary(inputs)


fragment("contact_flags", "week_base callers tiers failed density", f"""
  SELECT b.*, (SELECT account FROM callers x WHERE x.account = b.account AND x.period = b.period AND contacts = 1) AS one_call,
    (SELECT account FROM callers x WHERE x.account = b.account AND x.period = b.period AND contacts = 2) AS two_calls,
    (SELECT account FROM callers x WHERE x.account = b.account AND x.period = b.period AND contacts > 2) AS more_calls,
    (SELECT account FROM tiers x WHERE x.account = b.account AND x.period = b.period AND tier = '1') AS one_ticket,
    (SELECT account FROM tiers x WHERE x.account = b.account AND x.period = b.period AND tier = '2') AS two_tickets,
    (SELECT account FROM tiers x WHERE x.account = b.account AND x.period = b.period AND tier = '3+') AS more_tickets,
    {_mark('failed')} AS failed, d.tickets
  FROM week_base b LEFT JOIN density d ON d.account = b.account AND d.period = b.period""")
fragment("contact_summary", "contact_flags", f"""
  SELECT period, segment, count(DISTINCT account) AS active_base, {_counts(P.CONTACT_FLAGS)},
    CAST(sum(tickets) AS BIGINT) AS tickets
  FROM contact_flags WHERE final_churn_flag NOT IN ('Fixed Churner', 'Full Churner') GROUP BY period, segment""")


@case("contact_summary", "I14 I8 I9 I10 I11", "contact_summary", "SELECT * FROM contact_summary")
def _(inputs):
    return P.contact_summary(inputs)


@case("contact_summary_by_province", "I14", "contact_flags", f"""
  SELECT period, province, segment, count(DISTINCT account) AS active_base, {_counts(P.CONTACT_FLAGS)},
    CAST(sum(tickets) AS BIGINT) AS tickets
  FROM contact_flags WHERE final_churn_flag NOT IN ('Fixed Churner', 'Full Churner')
  GROUP BY period, province, segment""")
def _(inputs):
    return P.contact_summary(inputs, ("period", "province", "segment"))


fragment("calls", "deduped", f"""
  SELECT account, {wk('day')} AS period, count(*) FILTER (WHERE purpose = 'error') AS tech_calls,
    count(*) FILTER (WHERE purpose <> 'view') AS care_calls, count(*) FILTER (WHERE purpose = 'purchase') AS claims
  FROM deduped WHERE status <> 'ANULADA' GROUP BY 1, 2""")
fragment("per_1k", "week_base calls", """
  SELECT b.period, CAST(sum(rgus) AS BIGINT) AS rgus, CAST(sum(tech_calls) AS BIGINT) AS tech_calls,
    CAST(sum(care_calls) AS BIGINT) AS care_calls, round(sum(tech_calls) * 1000 / sum(rgus), 0) AS tech_calls_per_1k,
    round(sum(care_calls) * 1000 / sum(rgus), 0) AS care_calls_per_1k
  FROM week_base b LEFT JOIN calls c ON c.account = b.account AND c.period = b.period GROUP BY b.period""")


@case("calls_per_thousand_rgus", "I15", "per_1k", "SELECT * FROM per_1k")
def _(inputs):
    return P.calls_per_1k(inputs)


fragment("per_variation", "shocked calls", """
  SELECT b.period, count(*) AS variations, CAST(sum(claims) AS BIGINT) AS billing_calls,
    round(sum(claims) / count(*), 3) AS calls_per_variation
  FROM shocked b LEFT JOIN calls c ON c.account = b.account AND c.period = b.period
  WHERE bill_shock IS NOT NULL GROUP BY b.period""")


@case("billing_calls_per_variation", "I16", "per_variation", "SELECT * FROM per_variation")
def _(inputs):
    return P.calls_per_variation(inputs)


fragment("ftr", "deduped", f"""
  WITH billing AS (SELECT * FROM deduped WHERE purpose = 'purchase' AND status <> 'ANULADA')
  SELECT {wk('day')} AS period, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM billing p
      WHERE p.account = c.account AND p.day <= c.day AND c.day - p.day <= 3
        AND (p.start, p.interaction_id) < (c.start, c.interaction_id))) AS resolved,
    count(*) AS billing_calls,
    round(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM billing p
      WHERE p.account = c.account AND p.day <= c.day AND c.day - p.day <= 3
        AND (p.start, p.interaction_id) < (c.start, c.interaction_id))) / count(*), 3) AS ftr
  FROM billing c GROUP BY 1""")


@case("first_time_resolution_of_billing", "I17", "ftr", "SELECT * FROM ftr")
def _(inputs):
    return P.ftr(inputs)
