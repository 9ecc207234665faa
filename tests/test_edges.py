"""Hand-made edge cases and brute-force checks on small fixtures."""

import datetime as dt
import random
import re

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from abonara.functions import profile as P
from abonara.functions import rules as R
from abonara.functions.calendar import complete_months, complete_weeks, day_key_to_date, period_index
from abonara.operators import billing as B
from abonara.operators import checks as K
from abonara.operators import churn as E
from abonara.operators import contact as I
from abonara.operators import converge as C
from abonara.operators import dedup as D
from abonara.operators import snapshot as S
from abonara.sources import tables

DAY0 = dt.date(2022, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# -- calendar and text -----------------------------------------------------------------

def test_complete_months_equals_datesub(spark):
    rnd = random.Random(7)
    ends = [dt.date(2020, m, d) for m in (1, 2, 3, 4, 12) for d in (1, 28, 29, 30, 31)
            if not (m == 2 and d > 29) and not (m == 4 and d > 30)]
    pairs = [(rnd.choice(ends), rnd.choice(ends) + dt.timedelta(days=rnd.choice((0, 365, 366, 59)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a date, b date")
    ours = [r[0] for r in df.select(complete_months(F.col("a"), F.col("b"))).collect()]
    con = duckdb.connect()
    theirs = [con.execute("SELECT datesub('month', ?::DATE, ?::DATE)", p).fetchall()[0][0] for p in pairs]
    assert ours == theirs


def test_week_and_period_helpers(spark):
    df = spark.createDataFrame([(day(0), day(13)), (day(13), day(0)), (day(0), day(40))], "a date, b date")
    got = rows(df.select(complete_weeks(F.col("a"), F.col("b")).alias("w"),
                         period_index(F.col("a"), F.col("b"), "month").alias("m")), "w", "m")
    assert got == sorted([(1, 0), (-1, 0), (5, 1)], key=str)


def test_day_keys(spark):
    df = spark.createDataFrame([("20220131",), ("20220230",), ("x",), (None,)], "k string")
    assert [r[0] for r in df.select(day_key_to_date(F.col("k"))).collect()] == [dt.date(2022, 1, 31), None, None, None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("abc ", max_size=12), min_size=1, max_size=6))
def test_like_any_equals_like(texts):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    patterns = ("%ab%c%", "%b%b%", "%ca %")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(R.like_any(F.col("t"), patterns)).collect()]
    regexes = [re.compile(".*".join(map(re.escape, p.strip("%").split("%"))), re.S) for p in patterns]
    assert got == [any(x.search(t) for x in regexes) for t in texts]


def test_like_any_is_linear_on_hostile_text(spark):
    df = spark.createDataFrame([("ab" * 200_000,)], "t string")
    assert df.select(R.like_any(F.col("t"), ("%a%b%zz%", "%b%a%b%"))).collect()[0][0] is True


def test_like_any_rejects_other_patterns(spark):
    for bad in ("abc", "%a_b%", "%a"):
        with pytest.raises(ValueError):
            R.like_any(F.col("t"), (bad,))


def test_profile_edges(spark):
    df = spark.createDataFrame([("1", "", None, "x"), ("2", None, None, None), ("3", "v", "t", "b")],
                               "account string, vo_nm string, tv_nm string, bb_nm string")
    df = P.rgu_flags(df).select("account", P.product_mix().alias("mix"), P.bundle_name().alias("bundle"))
    assert rows(df, "account", "mix", "bundle") == [("1", "1P", "BB"), ("2", "0P", None), ("3", "3P", "BB+TV+VO")]


def test_last10(spark):
    df = spark.createDataFrame([("7",), ("123456789012",), ("",), (None,)], "k string")
    assert [r[0] for r in df.select(P.last10(F.col("k"))).collect()] == ["0000000007", "3456789012", "0000000000", None]


def test_channel_and_movement_labels(spark):
    df = spark.createDataFrame([("PROM norte",), ("Telefono",), ("Gestión 2",), ("??",), (None,)], "c string")
    got = [r[0] for r in df.select(P.channel_group(F.col("c"))).collect()]
    assert got == ["D2D (Own Sales force)", "Digital", "Outbound – TeleSales", None, None]


def test_claims_are_first_match(spark):
    df = spark.createDataFrame([("CLAIM", "instalacion y pago"), ("CLAIM", "pago"), ("CLAIM", "nada"),
                                ("TICKET", "pago"), ("X", "pago")], "p string, t string")
    got = [r[0] for r in df.select(P.classify_claim(F.col("p"), F.col("t"))).collect()]
    assert got == ["installation_claim", "billing_claim", "other_claims", "tech_ticket", None]


# -- ages and snapshots ----------------------------------------------------------------

def test_age_repair(spark):
    ages = [10, 11, 50, 13, 14, None, 16, 17, 2, 19]
    df = spark.createDataFrame([("a", day(i), a) for i, a in enumerate(ages)], "account string, dt date, age int")
    fixed = [r.age_fix for r in D.repair_age(df).orderBy("dt").collect()]
    assert fixed == [10, 11, 12, 13, 14, 15, 16, 17, 18, 19]


def test_age_repair_of_single_row(spark):
    df = spark.createDataFrame([("a", day(0), 5)], "account string, dt date, age int")
    assert D.repair_age(df).collect()[0].age_fix == 5
    assert D.repair_age(df, isolated_to_null=True).collect()[0].age_fix is None


def test_keep_one_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 1, 2), ("b", None, 9)], "k string, o int, id int")
    assert rows(D.keep_one(df, ["k"], [F.col("o").asc_nulls_last(), F.asc("id")]), "k", "id") == [("a", 2), ("b", 9)]


def test_boundary_days_and_threshold(spark):
    snap = [("a", dt.date(2022, 1, 31), 89), ("b", dt.date(2022, 1, 31), 90), ("c", dt.date(2022, 1, 31), None),
            ("d", dt.date(2022, 1, 30), 1), ("e", dt.date(2022, 1, 31), 91)]
    df = spark.createDataFrame(snap, "account string, dt date, age int")
    bom = S.bom_snapshot(df, ["age"])
    eom = S.eom_snapshot(df, ["age"])
    assert rows(bom, "account", "period") == [("a", dt.date(2022, 2, 1)), ("c", dt.date(2022, 2, 1))]
    assert [r[0] for r in rows(eom, "account")] == ["a", "b", "c"]


def test_stuck_age_can_be_overruled(spark):
    df = spark.createDataFrame([("a", dt.date(2022, 1, 31), 95, dt.date(2022, 1, 1))],
                               "account string, dt date, age int, unpaid_dt date")
    assert S.bom_snapshot(df, ["age"]).count() == 0
    assert S.bom_snapshot(df, ["age"], unpaid="unpaid_dt").count() == 1


def test_one_pass_pairing_equals_join(spark):
    rnd = random.Random(3)
    data = [(f"{a}", dt.date(2022, m, 28), rnd.choice((None, 5, 89, 90, 91, 120)), rnd.randint(0, 3))
            for a in range(40) for m in range(1, 8) if rnd.random() < .6]
    df = spark.createDataFrame(data, "account string, dt date, age int, num_rgus int")
    closing = S.closing_rows(df, "month")
    columns = ["age", "num_rgus"]
    joined = S.pair_snapshots(S.bom_snapshot(closing, columns, boundary=None), S.eom_snapshot(closing, columns, boundary=None))
    passed = S.pair_closing_rows(closing, columns)
    names = ["period", "account", "active_bom", "active_eom", "b_age", "e_age", "b_num_rgus", "e_num_rgus"]
    assert rows(joined, *names) == rows(passed, *names)


def test_pairing_looks_back_two_periods_and_keeps_undated_rows(spark):
    rnd = random.Random(5)
    data = [(a, m, rnd.choice((None, 5, 89, 90, 120))) for a in ("a", "b", "c", None) for m in range(1, 13) if rnd.random() < .6]
    at = {(a, m): age for a, m, age in data}
    first = lambda m: dt.date(2022 + (m - 1) // 12, (m - 1) % 12 + 1, 1)
    df = spark.createDataFrame([(a, dt.date(2022, m, 28), age, 10 * m) for a, m, age in data] + [("u", None, 5, 7)],
                               "account string, dt date, age int, n int")
    got = S.pair_closing_rows(df.withColumn("period", F.trunc("dt", "month")), ["n"], earlier=["n"])
    want = [("u", None, 1, 1, 7, 7, None)]
    for a in ("a", "b", "c", None):
        for m in range(1, 14):
            kept = lambda k, old: (a, k) in at and (at[a, k] is None or at[a, k] < 90 or at[a, k] == old)  # noqa: E731, B023
            b, e = kept(m - 1, None), kept(m, 90)
            if b or e:
                want.append((a, first(m), int(b), int(e), 10 * (m - 1) if b else None, 10 * m if e else None,
                             10 * (m - 2) if (a, m - 2) in at else None))
    names = ["account", "period", "active_bom", "active_eom", "b_n", "e_n", "p_n"]
    assert rows(got, *names) == sorted(want, key=str)


# -- churn -----------------------------------------------------------------------------

def test_involuntary_needs_neighbouring_periods(spark):
    data = [("a", dt.date(2022, 1, 31), 80), ("a", dt.date(2022, 2, 28), 95),
            ("b", dt.date(2022, 1, 31), 80), ("b", dt.date(2022, 3, 31), 95),
            ("c", dt.date(2022, 1, 31), 95), ("c", dt.date(2022, 2, 28), 120)]
    df = spark.createDataFrame([(a, d, g, d - dt.timedelta(days=g)) for a, d, g in data],
                               "account string, dt date, age_fix int, unpaid_dt date")
    assert rows(E.involuntary(E.record_brackets(df)), "account", "period") == [("a", dt.date(2022, 2, 1))]


def test_voluntary_order_window(spark):
    lost = spark.createDataFrame([("a", dt.date(2022, 3, 1)), ("b", dt.date(2022, 3, 1)), ("c", dt.date(2022, 3, 1))],
                                 "account string, period date")
    orders = spark.createDataFrame(
        [("a", dt.date(2022, 2, 5), "FINALIZADA"), ("a", dt.date(2022, 3, 5), "FINALIZADA"),
         ("b", dt.date(2022, 1, 31), "FINALIZADA"), ("c", dt.date(2022, 3, 1), "PENDIENTE")],
        "account string, completed date, status string").withColumn("order_type", F.lit("DESINSTALACION"))
    got = E.voluntary_by_order(lost, orders)
    assert got.count() == 3
    assert rows(got.where(F.col("voluntary").startswith("1")), "account") == [("a",)]


# -- convergence -----------------------------------------------------------------------

def test_shared_email_adds_no_rows(spark):
    fixed = spark.createDataFrame([(str(i), "HOT@X.COM") for i in range(200)] + [("z", "NA@GMAIL.COM")],
                                  "account string, email string")
    mobile = spark.createDataFrame([(f"m{i}", "HOT@X.COM", None) for i in range(300)] + [("n", "NA@GMAIL.COM", "na@gmail.com")],
                                   "mobile_account string, b_email string, e_email string")
    got = C.near_fmc(mobile, fixed)
    assert got.count() == 301
    hot = got.where("b_near_email = 'HOT@X.COM'")
    assert hot.count() == 300 and {r.b_near_accounts for r in hot.collect()} == {200}
    assert got.where("mobile_account = 'n' AND b_near_email IS NULL AND e_near_email IS NULL").count() == 1


def test_multiplicity_of_null_keys_is_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, v int")
    assert rows(D.attach_multiplicity(df, ["k"]), "v", "copies") == [(1, 1), (2, 1), (3, 2), (4, 2)]


# -- billing and contacts --------------------------------------------------------------

def test_december_month_window(spark):
    pay = spark.createDataFrame([("a", dt.date(2023, 1, 15), "5.0", 1), ("a", dt.date(2023, 1, 16), "7.0", 2),
                                 ("a", dt.date(2023, 1, 1), "junk", 3)],
                                "account string, dt date, amount_text string, payment_id int")
    cycle = spark.createDataFrame([("a", dt.date(2022, 12, 15), 6.0)], "account string, first_bill date, max_mrc double")
    got = B.payment_windows(pay, cycle, {"1m": B.months(1)}, 45, B.months(3)).collect()[0]
    assert (got.paid_1m, got.paid_total, got.enough_day) == (5.0, 12.0, dt.date(2023, 1, 16))


def test_no_payment_is_never_paid(spark):
    cycle = spark.createDataFrame([("a", DAY0, 6.0), ("b", DAY0, 6.0)], "account string, first_bill date, max_mrc double")
    pay = spark.createDataFrame([("b", day(1), "6.0", 1)], "account string, dt date, amount_text string, payment_id int")
    paid = B.payment_windows(pay, cycle, {"7": B.days(7)}, 0, B.days(30))
    assert rows(B.npn_flags(cycle, paid, ["7"], never=31), "account", "npn_7", "days_unpaid") == [("a", "a", 31), ("b", None, 1)]


def _calls(spark, seed=5, n=400):
    rnd = random.Random(seed)
    data = [(i, "hot" if rnd.random() < .4 else f"u{rnd.randint(0, 20)}", day(rnd.randint(0, 80))) for i in range(n)]
    return data, spark.createDataFrame(data, "interaction_id int, account string, day date")


def test_first_time_resolution_against_brute_force(spark):
    data, df = _calls(spark)
    got = {r.period: (r.resolved, r.billing_calls) for r in I.ftr_billing(df, 14).collect()}
    want = {}
    for i, a, d in data:
        earlier = any(b == a and (e, j) < (d, i) and (d - e).days <= 14 for j, b, e in data)
        solved, total = want.get(d.replace(day=1), (0, 0))
        want[d.replace(day=1)] = (solved + (not earlier), total + 1)
    assert got == want


def test_repeat_callers_against_brute_force(spark):
    data, df = _calls(spark, 9)
    df = df.withColumns({"status": F.lit("CERRADA"), "purpose": F.lit("x")})
    got = {(r.account, r.period): r.contacts for r in I.repeat_callers(df, 30).collect()}
    want = {}
    for a, p in {(a, d.replace(day=1)) for _, a, d in data}:
        last = max(d for _, b, d in data if b == a and d.replace(day=1) == p)
        want[a, p] = sum(b == a and 0 <= (last - d).days <= 30 for _, b, d in data)
    assert got == want


def test_order_near_contact_against_pairs(spark):
    rnd = random.Random(1)
    c = [(f"u{rnd.randint(0, 9)}", day(rnd.randint(0, 58))) for _ in range(60)]
    o = [(f"u{rnd.randint(0, 9)}", day(rnd.randint(0, 58))) for _ in range(60)]
    contacts, orders = spark.createDataFrame(c, "account string, day date"), spark.createDataFrame(o, "account string, start date")
    snap = spark.createDataFrame([(f"u{i}", d) for i in range(10) for d in (day(0), day(31))], "account string, dt date")
    want = {a for a, x in c for b, y in o if a == b and x.month == y.month and (x - y).days <= -5}
    assert K.order_near_contact(snap, contacts, orders, -5).collect()[0].accounts == len(want)


def test_flags_do_not_multiply_the_base(spark):
    base = spark.createDataFrame([("a", DAY0), ("b", DAY0)], "account string, period date")
    many = spark.createDataFrame([("a", DAY0)] * 5, "account string, period date")
    got = I.attach_flags(base, {"x": many, "y": many.limit(0)})
    assert rows(got, "account", "x", "y") == [("a", "a", None), ("b", None, None)]
    summary = I.driver_summary(got, ["period"], ["x", "y"]).collect()[0]
    assert (summary.active_base, summary.x, summary.y) == (2, 1, 0)


# -- sinks -----------------------------------------------------------------------------

def test_month_is_saved_once(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(DAY0, 1), (dt.date(2022, 2, 1), 2)], "period date, v int")
    assert tables.save_month(df, path, "2022-01-01")
    assert not tables.save_month(df.withColumn("v", F.lit(9)), path, "2022-01-01")
    assert rows(tables.read_periods(spark, path), "period", "v") == [(DAY0, 1)]
    assert tables.save_month(df.withColumn("v", F.lit(9)), path, "2022-01-01", replace=True)
    assert rows(tables.read_periods(spark, path), "v") == [(9,)]


def test_only_written_periods_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(DAY0, 1), (dt.date(2022, 2, 1), 2)], "period date, v int")
    tables.save_periods(df, path)
    tables.save_periods(df.where("v = 2").withColumn("v", F.lit(7)), path)
    assert rows(tables.read_periods(spark, path), "v") == [(1,), (7,)]
    assert tables.read_periods(spark, path, first="2022-02-01").count() == 1


# -- hot keys and the shared folder ----------------------------------------------------

def test_hot_contract_keeps_every_line(spark):
    fixed = spark.createDataFrame([(DAY0, "77", 1, 1), (DAY0, "88", 1, 0)],
                                  "period date, fixed_account string, active_bom int, active_eom int")
    mobile = spark.createDataFrame([(DAY0, f"m{i}", "77" if i < 50 else f"9{i}", 1, 1) for i in range(60)],
                                   "period date, mobile_account string, fmc_account string, "
                                   "mobile_active_bom int, mobile_active_eom int")
    got = C.converge(fixed, mobile)
    assert got.count() == 61
    assert {r.copies for r in got.where("fixed_account = '77'").collect()} == {50}
    assert rows(got.where("mobile_account IS NULL"), "final_account", "copies", "final_eom_active") == [("88", 1, 0)]
    assert got.where("fixed_account IS NULL AND copies = 1").count() == 10


def test_null_keys_and_periods_meet_each_other(spark):
    fixed = spark.createDataFrame([(DAY0, None, 1, 1), (None, "88", 1, 0), (DAY0, "", 1, 1)],
                                  "period date, fixed_account string, active_bom int, active_eom int")
    mobile = spark.createDataFrame([(DAY0, "m1", None, 1, 1), (None, "m2", "88", 1, 1), (None, None, None, 1, 1)],
                                   "period date, mobile_account string, fmc_account string, "
                                   "mobile_active_bom int, mobile_active_eom int")
    got = rows(C.converge(fixed, mobile), "period", "fixed_account", "mobile_account", "active_bom", "copies")
    assert got == sorted([(DAY0, None, "m1", 1, 1), (None, "88", "m2", 1, 1), (None, None, None, None, 1),
                          (DAY0, "", None, 1, 1)], key=str)


def test_shared_folder_of_the_session_is_used():
    from types import SimpleNamespace
    from abonara.session import ensure_checkpoint_dir
    used = []
    context = SimpleNamespace(master="yarn", setCheckpointDir=used.append)
    named = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: "/shared/cp"))
    assert ensure_checkpoint_dir(named) == "/shared/cp" and used == ["/shared/cp"]
    unnamed = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(unnamed)
