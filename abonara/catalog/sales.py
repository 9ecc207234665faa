"""Sales, billing and never-paid."""

from pyspark.sql import functions as F

from abonara.catalog.base_sql import q
from abonara.catalog.registry import case, fragment
from abonara.functions import values as V
from abonara.operators import billing as B
from abonara.operators import sales as G
from abonara.plans import sales_quality as P


@case("sales_from_orders", "G1", "service_orders snap", f"""
  SELECT o.account, order_id, {q('completed')} AS period,
    CASE WHEN {q('completed')} < {q('appears')} THEN 'DNA data delayed' ELSE 'Mismo mes' END AS sale_kind
  FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY completed, order_id) AS nth
        FROM service_orders WHERE order_type = 'INSTALACION' AND status = 'FINALIZADA') o
  JOIN (SELECT account, least(min(dt), min(inst_dt)) AS appears FROM snap GROUP BY account) s
    ON s.account = o.account
  WHERE nth = 1 AND {q('completed')} <= {q('appears')}
    AND {q('start')} BETWEEN DATE '1995-01-01' AND DATE '2001-10-01'""")
def _(inputs):
    return G.sale_from_orders(inputs.service_orders, inputs.snap, P.day("1995-01-01"),
                              P.day("2001-10-01"), "quarter").select(
        "account", "order_id", "period", "sale_kind")


@case("new_by_absence", "G2", "snap", f"""
  SELECT account, min(dt) AS first_day FROM snap WHERE {q('dt')} = DATE '1998-04-01'
    AND account NOT IN (SELECT account FROM snap
      WHERE {q('dt')} BETWEEN DATE '1997-07-01' AND DATE '1998-01-01' AND account IS NOT NULL)
  GROUP BY account""")
def _(inputs):
    return G.new_by_absence(inputs.snap, P.day("1998-04-01"), 3, "quarter")


@case("new_by_first_seen", "G3", "snap", f"""
  SELECT account, min(dt) AS first_day FROM snap WHERE dt BETWEEN DATE '1996-10-01' AND DATE '1998-07-01'
  GROUP BY account HAVING {q('min(dt)')} = DATE '1998-04-01'""")
def _(inputs):
    return G.new_by_first_seen(inputs.snap, P.day("1998-04-01"), 6, 1, "quarter")


@case("new_by_connect_date", "G4", "snap", f"""
  SELECT account, connect_dt, {q('connect_dt')} AS install_period
  FROM (SELECT account, arg_max(inst_dt, dt) AS connect_dt FROM snap
        WHERE dt < DATE '2001-10-01' AND inst_dt BETWEEN DATE '2000-10-01' AND DATE '2001-09-30' GROUP BY account) c
  WHERE {q('connect_dt')} = DATE '2001-01-01'""")
def _(inputs):
    return G.new_by_connect(inputs.snap, P.day("2001-07-01"), 2, "quarter")


@case("sale_dates_by_install", "G5", "snap", f"""
  SELECT DISTINCT account, {q('inst_dt')} AS install_period, first_day,
    greatest({q('inst_dt')}, {q('first_day')}) AS sale_period
  FROM (SELECT *, min(dt) OVER (PARTITION BY account) AS first_day FROM snap) s""")
def _(inputs):
    return G.sale_date(inputs.snap, "quarter")


fragment("sale_attrs", "gross_adds", """
  SELECT account, CAST(sales_day AS DATE) AS sale_day, channel, seller,
    CAST(rgus_sold_text AS INTEGER) AS sold_rgus
  FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY sales_day, sale_id) AS nth
        FROM gross_adds WHERE sales_day <> '') g WHERE nth = 1""")


@case("first_sale_attributes", "G6", "sale_attrs", "SELECT * FROM sale_attrs")
def _(inputs):
    return G.first_sale_attrs(inputs.gross_adds)


@case("first_sale_attributes_of_a_quarter", "G6", "gross_adds", """
  SELECT account, CAST(sales_day AS DATE) AS sale_day, channel, seller,
    CAST(rgus_sold_text AS INTEGER) AS sold_rgus
  FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY sales_day, sale_id) AS nth
        FROM gross_adds WHERE sales_day BETWEEN '1999-01-01' AND '1999-03-31') g WHERE nth = 1""")
def _(inputs):
    return G.first_sale_attrs(inputs.gross_adds, P.day("1999-01-01"), "quarter")


@case("first_installs_after_first_seen", "G7", "snap", """
  SELECT account, min(inst_dt) AS first_install
  FROM (SELECT *, min(dt) OVER (PARTITION BY account) AS first_day FROM snap) s
  WHERE inst_dt >= first_day GROUP BY account""")
def _(inputs):
    return G.first_install(inputs.snap, G.first_seen(inputs.snap))


fragment("first_bills", "bills", """
  SELECT account, first(bill_dt ORDER BY dt, row_id) FILTER (WHERE bill_dt IS NOT NULL) AS first_bill
  FROM bills GROUP BY account""")


@case("first_bills", "G8", "first_bills", "SELECT * FROM first_bills WHERE first_bill IS NOT NULL")
def _(inputs):
    return B.first_bill(inputs.bills)


fragment("max_mrc", "bills first_bills", """
  SELECT b.account, first_bill, max(mrc) AS max_mrc,
    list_sort(list(DISTINCT mrc), 'DESC') AS mrcs
  FROM (SELECT account, dt, max(mrc) AS mrc FROM bills GROUP BY ALL) b JOIN first_bills f ON f.account = b.account
    AND dt BETWEEN first_bill AND first_bill + 7 GROUP BY ALL""")


@case("max_charges_after_first_bill", "G9", "max_mrc", """
  SELECT account, first_bill, max_mrc, array_to_string(mrcs, '|') AS mrcs FROM max_mrc""")
def _(inputs):
    mrc = B.max_mrc_window(inputs.bills, B.first_bill(inputs.bills), B.days(8))
    return mrc.withColumn("mrcs", F.array_join(F.col("mrcs").cast("array<string>"), "|"))


@case("max_charges_in_two_months", "G9", "bills first_bills", """
  SELECT b.account, first_bill, max(mrc) AS max_mrc FROM bills b JOIN first_bills f
    ON f.account = b.account AND dt BETWEEN first_bill AND CAST(first_bill + INTERVAL '2' MONTH AS DATE)
  GROUP BY ALL""")
def _(inputs):
    return B.max_mrc_window(inputs.bills, B.first_bill(inputs.bills), B.months(2)).drop("mrcs")


fragment("cycle", "bills max_mrc", """
  SELECT b.account, min(first_bill) AS first_bill, max(mix_qty) AS max_rgus, min(dt) AS first_day,
    max(max_mrc) AS max_mrc, CAST(DATE '2024-01-25' - min(first_bill) AS INTEGER) AS days_since_bill
  FROM bills b JOIN max_mrc m ON m.account = b.account AND m.first_bill = b.bill_dt GROUP BY b.account""")


@case("first_cycles", "G10", "cycle", "SELECT * FROM cycle")
def _(inputs):
    return P.cycle(inputs)


def _paid(facts, back):
    return f"""
  SELECT p.account, min(dt) AS first_pay, max(dt) AS last_pay,
    first(amount ORDER BY dt, payment_id) AS first_amount,
    first(amount ORDER BY dt, payment_id) FILTER (WHERE amount >= max_mrc) AS enough_amount,
    first(dt ORDER BY dt, payment_id) FILTER (WHERE amount >= max_mrc) AS enough_day,
    round(sum(amount), 2) AS paid_total,
    round(sum(amount) FILTER (WHERE dt - first_bill < 7), 2) AS paid_7,
    round(sum(amount) FILTER (WHERE dt - first_bill < 14), 2) AS paid_14,
    round(sum(amount) FILTER (WHERE dt - first_bill < 21), 2) AS paid_21
  FROM payments p JOIN {facts} c ON c.account = p.account
    AND dt BETWEEN first_bill - {back} AND first_bill + 21 GROUP BY p.account"""


fragment("paid", "payments cycle", _paid("cycle", 5))


@case("payments_after_first_bill", "G11", "paid", "SELECT * FROM paid")
def _(inputs):
    return P.paid(inputs, P.cycle(inputs))


@case("payments_by_month_windows", "G11", "payments cycle", """
  SELECT p.account, min(dt) AS first_pay, max(dt) AS last_pay, round(sum(amount), 2) AS paid_total,
    round(sum(amount) FILTER (WHERE dt <= CAST(first_bill + INTERVAL '1' MONTH AS DATE)), 2) AS paid_1m
  FROM payments p JOIN cycle c ON c.account = p.account
    AND dt BETWEEN first_bill - 45 AND CAST(first_bill + INTERVAL '3' MONTH AS DATE) GROUP BY p.account""")
def _(inputs):
    return B.payment_windows(inputs.payments, P.cycle(inputs), {"1m": B.months(1)}, 45, B.months(3)).select(
        "account", "first_pay", "last_pay", "paid_total", "paid_1m")


def _npn(paid):
    short = lambda c: f"CASE WHEN {c} >= max_mrc THEN NULL ELSE c.account END"
    return f"""{paid}.* EXCLUDE (account), {short('paid_7')} AS npn_7, {short('paid_14')} AS npn_14,
    {short('paid_21')} AS npn_21, {short('paid_total')} AS npn,
    CAST(coalesce(enough_day - first_bill, 22) AS INTEGER) AS days_unpaid"""


fragment("npn", "cycle paid", f"""
  SELECT c.*, {_npn('paid')} FROM cycle c LEFT JOIN paid ON paid.account = c.account""")


@case("never_paid_flags", "G12", "npn", "SELECT * FROM npn")
def _(inputs):
    return P.never_paid(inputs)


fragment("billed_sales", "npn", "SELECT *, " + ", ".join(
    f"""CASE WHEN DATE '2024-01-25' - first_bill > {n} THEN 'Completed {n} Days' ELSE 'Uncomplete {n} days' END AS window_{n},
    CASE WHEN DATE '2024-01-25' - first_bill >= {n} THEN account END AS complete_{n}""" for n in (7, 14, 21)) + " FROM npn")


@case("completed_windows", "G13", "billed_sales", """
  SELECT account, first_bill, window_7, window_14, window_21, complete_7, complete_14, complete_21
  FROM billed_sales""")
def _(inputs):
    return P.billed_sales(inputs).select(
        "account", "first_bill", *[f"{k}_{n}" for k in ("window", "complete") for n in (7, 14, 21)])


@case("soft_disconnects_of_densest_day", "G14 C7", "account_firsts repaired", f"""
  SELECT c.period, c.account, max(age_fix) AS max_age,
    CASE WHEN max(age_fix) BETWEEN 26 AND 89 THEN c.account END AS soft_dx,
    CASE WHEN max(age_fix) >= 90 THEN c.account END AS never_paid
  FROM (SELECT {q('start_dt')} AS period, account, start_dt, dense_rank() OVER (
          PARTITION BY {q('start_dt')} ORDER BY n DESC, start_dt) AS nth
        FROM (SELECT *, count(*) OVER (PARTITION BY start_dt) AS n FROM account_firsts) x) c
  LEFT JOIN repaired r ON r.account = c.account WHERE nth = 1 GROUP BY c.period, c.account""")
def _(inputs):
    cohort = G.densest_day_cohort(G.first_seen(inputs.snap), "quarter")
    return G.soft_dx(P.repaired(inputs), cohort)


@case("soft_disconnects_on_first_bill_month", "G15", "repaired", f"""
  SELECT {q('start')} AS sale_period, account, max(age_fix) AS max_age,
    CASE WHEN max(age_fix) >= 26 THEN account END AS soft_dx,
    CASE WHEN max(age_fix) >= 90 THEN account END AS never_paid
  FROM (SELECT *, min(bill_dt) OVER w AS first_bill, min(dt) OVER w AS start FROM repaired
        WINDOW w AS (PARTITION BY account)) r
  WHERE {q('first_bill')} = {q('unpaid_dt')} GROUP BY 1, account""")
def _(inputs):
    return G.soft_dx_first_bill(P.billed_ages(inputs), grain="quarter")


@case("soft_and_hard_disconnects", "G16 B11", "snap", f"""
  SELECT account, unpaid_dt, install, max(age) AS max_age, CAST(max(overdue) AS INTEGER) AS max_overdue,
    max(dt) AS last_day, {q('install')} AS install_period,
    CAST(CASE WHEN {q('install')} < DATE '1998-01-01' THEN max(age) >= 46 ELSE max(overdue) >= 5 END AS INTEGER) AS soft_dx,
    CAST(max(age) >= 90 AS INTEGER) AS hard_dx,
    CAST(unpaid_dt + 46 < DATE '1999-01-01' AS INTEGER) AS soft_window_done,
    CAST(unpaid_dt + 90 < DATE '1999-01-01' AS INTEGER) AS hard_window_done
  FROM (SELECT *, age - (due_dt - bill_dt) AS overdue FROM snap WHERE age IS NOT NULL) o
  JOIN (SELECT account, unpaid_dt, inst_dt AS install FROM (SELECT *, row_number() OVER (
      PARTITION BY account ORDER BY dt) AS nth FROM snap WHERE age IS NOT NULL) f WHERE nth = 1) g
    USING (account, unpaid_dt)
  GROUP BY account, unpaid_dt, install""")
def _(inputs):
    return G.soft_hard_dx(P.with_overdue(inputs), P.day("1999-01-01"), P.day("1998-01-01"), grain="quarter")


fragment("week_newcomers", "bills", """
  SELECT account, min(dt) AS first_day FROM bills
  WHERE dt BETWEEN DATE '2023-12-18' AND DATE '2024-01-29' GROUP BY account
  HAVING min(dt) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""")

_named = lambda s: " + ".join(f"({s}.{n}_nm IS NOT NULL)::INTEGER" for n in ("bb", "vo", "tv"))
_diff = " + ".join(f"(coalesce(l.{n}_nm, 'NA') <> coalesce(f.{n}_nm, 'NA'))::INTEGER" for n in ("bb", "vo", "tv"))

fragment("upsells", "bills week_newcomers", f"""
  SELECT f.account, f.mix_qty AS first_mix_qty, l.mix_qty AS last_mix_qty,
    {_named('f')} AS first_named_rgus, {_named('l')} AS last_named_rgus, {_diff} AS changed_products,
    round(l.mrc - f.mrc, 2) AS mrc_change,
    (SELECT min(dt) FROM wk w WHERE w.account = f.account AND w.mix_qty = l.mix_qty) AS reached_on,
    CASE WHEN l.mix_qty > f.mix_qty THEN 'Upsell' ELSE 'Other' END AS upsell_kind,
    l.mix_qty - f.mix_qty AS upsell_rgus, {_named('l')} - ({_named('f')}) AS upsell_named_rgus,
    {_diff} > 0 AS product_changed
  FROM (SELECT * FROM wk WHERE up = 1) f JOIN (SELECT * FROM wk WHERE down = 1) l ON l.account = f.account
""".replace("wk", "week_rows"))
fragment("week_rows", "bills week_newcomers", """
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY dt, row_id) AS up,
    row_number() OVER (PARTITION BY account ORDER BY dt DESC, row_id DESC) AS down
  FROM bills WHERE dt BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
    AND account NOT IN (SELECT account FROM week_newcomers)""")


@case("upsell_candidates", "G17", "week_rows upsells", "SELECT * FROM upsells")
def _(inputs):
    return P.upsells(inputs)


fragment("upsell_cycle", "week_rows upsells", """
  SELECT b.account, first_bill, max(mrc) AS max_mrc FROM bills b JOIN (
    SELECT x.account, min(bill_dt) AS first_bill FROM bills x JOIN upsells u ON u.account = x.account
      AND bill_dt >= reached_on GROUP BY x.account) f
    ON f.account = b.account AND dt BETWEEN first_bill AND first_bill + 7 GROUP BY ALL""")
fragment("upsell_paid", "upsell_cycle payments", _paid("upsell_cycle", 0))
fragment("billed_upsells", "upsell_paid", f"""
  SELECT u.*, c.* EXCLUDE (account), {_npn('p')} FROM upsells u
  JOIN upsell_cycle c ON c.account = u.account LEFT JOIN upsell_paid p ON p.account = u.account""")


@case("upsell_billing", "G18", "billed_upsells", "SELECT * FROM billed_upsells")
def _(inputs):
    return P.billed_upsells(inputs)


_keep = "first_bill, max_mrc, paid_total, npn_7, npn_14, npn_21, npn"
fragment("merged_sales", "billed_sales billed_upsells sale_attrs", f"""
  SELECT m.*, a.* EXCLUDE (account),
    CASE WHEN base = 'Gross-add' THEN 'Gross Add' WHEN upsell_rgus > 0 THEN 'Upsell' ELSE 'Other' END AS movement,
    CASE WHEN base = 'Gross-add' AND max_rgus BETWEEN 1 AND 3 THEN CAST(max_rgus AS VARCHAR) || 'P'
      WHEN base = 'Upsell' AND first_mix_qty BETWEEN 1 AND 3 THEN CAST(first_mix_qty AS VARCHAR) || 'P' END AS bundle,
    coalesce(first_mix_qty, 0) AS first_rgus, coalesce(last_mix_qty, max_rgus) AS last_rgus,
    CASE WHEN base = 'Gross-add' THEN max_rgus WHEN upsell_rgus > 0 THEN upsell_rgus
      ELSE sold_rgus END AS rgus_counted,
    CASE WHEN channel LIKE '%D2D%' THEN 'D2D' ELSE channel END AS channel_group
  FROM (
    SELECT 'Gross-add' AS base, account, {_keep}, max_rgus, NULL::INTEGER AS first_mix_qty,
      NULL::INTEGER AS last_mix_qty, NULL::VARCHAR AS upsell_kind, NULL::INTEGER AS upsell_rgus,
      NULL::INTEGER AS upsell_named_rgus
    FROM billed_sales WHERE account IN (SELECT account FROM week_newcomers)
    UNION ALL
    SELECT 'Upsell', account, {_keep}, NULL, first_mix_qty, last_mix_qty, upsell_kind, upsell_rgus,
      upsell_named_rgus FROM billed_upsells) m
  JOIN sale_attrs a ON a.account = m.account""")


@case("merged_sales", "G19 G20", "merged_sales", "SELECT * FROM merged_sales")
def _(inputs):
    return P.merged_sales(inputs)


@case("sales_by_movement_and_bundle", "G20", "merged_sales", """
  SELECT movement, bundle, channel_group, count(*) AS sales, CAST(sum(rgus_counted) AS BIGINT) AS rgus,
    count(npn) AS never_paid FROM merged_sales GROUP BY ALL""")
def _(inputs):
    return P.merged_sales(inputs).groupBy("movement", "bundle", "channel_group").agg(
        F.count("*").alias("sales"), F.sum("rgus_counted").alias("rgus"), F.count("npn").alias("never_paid"))


@case("reported_versus_counted_rgus", "G21", "merged_sales", """
  SELECT account, movement, sold_rgus, rgus_counted,
    CASE WHEN sold_rgus > rgus_counted THEN 'reported' ELSE 'counted' END AS greater
  FROM merged_sales WHERE sold_rgus <> rgus_counted""")
def _(inputs):
    return G.rgu_compare(P.merged_sales(inputs)).select(
        "account", "movement", "sold_rgus", "rgus_counted", "greater")
