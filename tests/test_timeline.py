"""The account timeline, array histories, stored bitmaps and the two later fixed tables on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from abonara.functions import values as V
from abonara.operators import billing as B
from abonara.operators import bitmaps as M
from abonara.operators import cohort as H
from abonara.operators import history as A
from abonara.operators import timeline as L
from abonara.plans import rewrites as R
from abonara.sources.commits import PeriodStore

DAY = dt.date(2024, 1, 1)
BILLS = "account string, dt date, row_id long, bill_dt date, mrc double, mix_qty int"
PAYMENTS = "account string, dt date, payment_id long, amount_text string"
HORIZONS = {"7": B.days(7), "14": B.days(14)}


def on(n):
    return DAY + dt.timedelta(days=n)


def records(seed=2, accounts=40):
    rng, bills, payments = random.Random(seed), [], []
    for a in range(accounts):
        for k in range(rng.randint(0, 12)):
            day = rng.randint(0, 30)
            bill = rng.choice([None, on(day), on(max(0, day - 3))])
            bills.append((f"a{a}", on(day), a * 1000 + k, bill, float(rng.randint(5, 60)), rng.randint(0, 3)))
        for k in range(rng.randint(0, 10)):
            payments.append((f"a{a}", on(rng.randint(-10, 40)), a * 1000 + k, rng.choice(["10", "20.5", "55", "oops"])))
    return bills, payments


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_timeline_equals_the_joined_operators(spark):
    bills, payments = (spark.createDataFrame(d, s) for d, s in zip(records(), (BILLS, PAYMENTS)))
    first = B.first_bill(bills)
    cycle = B.first_cycle(bills, B.max_mrc_window(bills, first, B.days(8)))
    expected = cycle.join(B.payment_windows(payments, cycle, HORIZONS, 5, B.days(22)), "account", "left")
    stream = L.day_rows(bills, payments)
    facts = L.billing_facts(stream, HORIZONS, B.days(8), 5, B.days(22))
    found = facts.join(L.first_sufficient(payments, facts), "account", "left")
    columns = sorted(expected.columns)
    assert set(columns) <= set(found.columns)
    assert rows(found, columns) == rows(expected, columns)
    assert found.where("enough_amount IS NOT NULL").count() > 3
    # From an anchor day on, the earliest bill dated since counts.
    since = bills.groupBy("account").agg(F.expr("min(dt) + 4").cast("date").alias("since"))
    anchored = L.billing_facts(stream.join(since, "account"), HORIZONS, B.days(8), 0, B.days(22), F.col("since"))
    later = B.first_bill(bills, since.withColumnRenamed("since", "since_dt"))
    mrc = B.max_mrc_window(bills, later, B.days(8))
    assert rows(anchored, ["account", "first_bill", "max_mrc"]) == rows(mrc, ["account", "first_bill", "max_mrc"])
    paid = B.payment_windows(payments, mrc, HORIZONS, 0, B.days(22))
    own = anchored.where("first_pay IS NOT NULL")
    assert rows(own, ["account", "paid_total", "paid_7"]) == rows(paid, ["account", "paid_total", "paid_7"])


def test_an_account_brings_a_row_per_day(spark):
    """A hot account with thousands of records has as many stream rows as days and bill dates."""
    bills = spark.range(5000).select(F.lit("hot").alias("account"), F.lit(DAY).alias("dt"), F.col("id").alias("row_id"),
                                     F.lit(DAY).alias("bill_dt"), F.lit(9.0).alias("mrc"), F.lit(1).alias("mix_qty"))
    payments = spark.range(5000).select(F.lit("hot").alias("account"), F.lit(DAY).alias("dt"), F.col("id").alias("payment_id"),
                                        F.lit("1").alias("amount_text"))
    stream = L.day_rows(bills, payments)
    assert stream.count() == 2
    facts = L.billing_facts(stream, HORIZONS, B.days(8), 5, B.days(22)).collect()
    assert [(r.paid_total, r.enough_day, r.max_rgus) for r in facts] == [(5000.0, None, 1)]
    none = L.billing_facts(L.day_rows(bills.where("false"), payments), HORIZONS, B.days(8), 5, B.days(22))
    assert none.collect() == []


CLOSING = "account string, period date, age int, unpaid_dt date, mrc double, mix string, rgus int"


def test_histories_equal_the_joined_panel(spark):
    rng, data = random.Random(5), []
    for a in range(50):
        for m in sorted(rng.sample(range(1, 13), rng.randint(1, 9))):
            data.append((f"a{a}", dt.date(2022, m, 1), rng.choice([None, 10, 89, 90, 120]), dt.date(2022, m, rng.randint(1, 28)),
                         float(rng.randint(1, 9)), rng.choice(["0P", "1P", "2P"]), rng.randint(0, 3)))
    closing = spark.createDataFrame(data, CLOSING)
    live, gaps, as_of = F.col("mix") != "0P", ("2022-06-01",), F.to_date(F.lit("2022-10-15"))
    sales = closing.groupBy("account").agg(F.min("period").alias("sale_period"))
    panel = H.survival_panel(sales, closing, 6, "month", 90, live=live, gap_periods=gaps)
    expected = H.churn_type(H.churn_month(panel, as_of, 6, "month"), 6)
    followed = A.follow(closing, ["age", "unpaid_dt", "mrc", "rgus"], live, 6, "month")
    arrays = A.losses(A.survival(followed, "month", 90, gaps), as_of, "month")
    found = A.wide(arrays, ["account", "sale_period", "max_unpaid_dt"], {c: c for c in ("surv", "age", "churn", "churn_type")}, 6)
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found, expected.columns) == rows(expected, expected.columns)


def test_bitmap_counts_merge(spark, tmp_path):
    rng = random.Random(6)
    data = [(f"acct-{rng.randint(0, 300)}", dt.date(2022, rng.randint(1, 4), 1), rng.choice(["x", "y", None]), rng.choice([None, 1])) for _ in range(2000)]
    table = spark.createDataFrame(data + [(None, dt.date(2022, 1, 1), "x", 1)], "account string, period date, kind string, late int")
    store = PeriodStore(spark, str(tmp_path / "cube"))
    cube = M.DistinctCube(store, "cube", ["kind"], {"accounts": F.lit(True), "late": F.col("late").isNotNull()})
    march = table.where("period < '2022-04-01'")
    assert cube.add(march) == [dt.date(2022, m, 1) for m in (1, 2, 3)]
    numbers = {r.account: r.number for r in store.read("cube_accounts").collect()}
    cube.add(table.where("period = '2022-04-01'"))
    again = {r.account: r.number for r in store.read("cube_accounts").collect()}
    assert all(again[a] == n for a, n in numbers.items()) and len(set(again.values())) == len(again)
    for by, keys in (({"period": F.col("period"), "kind": F.col("kind")}, ["period", "kind"]), ({"year": F.trunc("period", "year")}, ["year"])):
        expected = table.withColumn("year", F.trunc("period", "year")).groupBy(*keys).agg(
            F.count_distinct("account").alias("accounts"), F.count_distinct(F.when(F.col("late").isNotNull(), F.col("account"))).alias("late"))
        assert rows(cube.counts(by), [*keys, "accounts", "late"]) == rows(expected, [*keys, "accounts", "late"])
    only = cube.counts({"period": F.col("period")}, dt.date(2022, 2, 1), dt.date(2022, 2, 1)).collect()
    assert [r.accounts for r in only] == [march.where("period = '2022-02-01'").select("account").distinct().count()]
    cube.add(table.where("period = '2022-04-01'"))  # a repeated run replaces the period
    assert rows(cube.counts({"year": F.trunc("period", "year")}), ["accounts"]) == [(table.select("account").dropna().distinct().count(),)]


def closing_rows(spark, states):
    """(account, month, age, rgus): closing rows on the last day of months of 2022."""
    data = []
    for account, month, age, rgus in states:
        data.append((account, dt.date(2022, month, 1), dt.date(2022, month, 28), age, rgus, f"{rgus}P", 10.0, 3, dt.date(2021, 1, 1), "HFC",
                     None, None, None))
    return spark.createDataFrame(data, "account string, period date, dt date, age int, num_rgus int, mix string, bill_amt double, "
                                       "tenure int, start_dt date, tech string, vo_nm string, tv_nm string, bb_nm string")


def test_order_fixed_table_types_losses(spark):
    closing = closing_rows(spark, [(a, 1, 50, 2) for a in "abcde"] + [("d", 2, 120, 2), ("e", 2, 10, 1), ("a", 3, 5, 2)])
    daily = spark.createDataFrame([("b", dt.date(2022, 2, 10), 95), ("d", dt.date(2022, 2, 20), 120), ("a", dt.date(2022, 2, 3), 50)],
                                  "account string, dt date, age int")
    day = dt.date(2022, 2, 5)
    orders = spark.createDataFrame([("c", V.DEINSTALL, V.FINISHED, "OTRO", day, day), ("d", V.DEINSTALL, V.FINISHED, "MOROSIDAD", day, day),
                                    ("e", V.DEINSTALL, V.FINISHED, "TRAMITE INTERNO", day, day)],
                                   "account string, order_type string, status string, command string, start date, completed date")
    got = {(r.account, r.period.month): r for r in R.order_fixed_table(closing, daily, orders).collect()}
    assert got["a", 2].churn_type == V.FIXED_VOLUNTARY and got["b", 2].churn_type == V.FIXED_INVOLUNTARY
    assert got["c", 2].churn_type == V.FIXED_VOLUNTARY and got["d", 2].churn_type == V.FIXED_EARLY
    assert (got["d", 2].rgu_churn, got["b", 2].rgu_churn, got["e", 2].rgu_churn) == (0, 2, 1)
    assert got["e", 2].churn_type is None and got["e", 2].transfer_flag == V.TRANSFER_OUT
    assert got["a", 3].rejoiner_flag == "Rejoiner" and got["e", 3].rejoiner_flag is None


def test_log_fixed_table_types_losses(spark):
    closing = closing_rows(spark, [(a, 1, 50, 2) for a in ("1", "2", "3", "4")] + [("4", 2, 10, 1), ("1", 3, 5, 2)])
    entry = lambda a, n, code, kind, text: (a, dt.date(2022, 2, n), n, code, kind, text)
    log = spark.createDataFrame([
        entry("1", 3, V.LOG_LEAVE, V.LOG_OUT, V.VOLUNTARY_DESCRIPTIONS[0]), entry("2", 4, V.LOG_LEAVE, V.LOG_OUT, V.INVOLUNTARY_DESCRIPTIONS[0]),
        entry("3", 5, V.LOG_SWITCH, V.LOG_OUT, "Otra"), entry("4", 6, V.LOG_SWITCH, V.LOG_OUT, "Otra")],
        "contract string, day date, seq int, code string, kind string, description string")
    business = spark.createDataFrame([(dt.date(2022, 2, 1), "2")], "period date, account string")
    got = {(r.account, r.period.month): r for r in R.log_fixed_table(closing, log, business).collect()}
    assert (got["1", 2].churn_type, got["2", 2].churn_type) == (V.FIXED_VOLUNTARY, V.FIXED_INVOLUNTARY)
    assert (got["1", 2].main_movement, got["2", 2].main_movement) == (V.LOSS, V.TO_BUSINESS)
    assert got["3", 2].churn_type is None and got["3", 2].transfer_flag == V.TRANSFER_OUT
    assert got["4", 2].transfer_flag == V.TRANSFER_OUT and got["1", 3].rejoiner_flag == "Rejoiner"


def test_merged_sales_reads_each_table_once(spark, folder):
    from abonara.catalog import CASES
    plan = CASES["merged_sales"].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 8
    for name in ("churn_periods", "churn_types_by_period", "mortality_at_six", "arpu_panel"):
        plan = CASES[name].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
        # Orders, their lines and parts; after the account shuffle of the repair none for the panel.
        assert plan.count("FileScan") == 3 and plan.count("Exchange hashpartitioning(account#") == 2
