"""Runs of single periods against runs over all history, commits, merged state, one-pass convergence."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from abonara.functions.calendar import period_of
from abonara.functions.profile import bundle_name, product_mix, rgu_count, rgu_flags, tech_flag
from abonara.operators import converge as C
from abonara.operators import partials as A
from abonara.operators import repair as R
from abonara.operators.dedup import repair_age
from abonara.operators.snapshot import account_closing
from abonara.plans import tables as T
from abonara.plans.periods import AccountRuns, fixed_period, fixed_state, next_period, period_facts
from abonara.sources.commits import NotReady, PeriodStore

SNAP = ("account string, dt date, age int, vo_nm string, tv_nm string, bb_nm string, bill_amt double, inst_dt date, "
        "last_pay_dt date, unpaid_dt date")
MONTHS = [dt.date(2022, m, 1) for m in range(1, 7)]


def history(accounts=60, seed=4):
    """Sparse daily rows with jumps, gaps and unknown ages, also across month ends; some accounts pause for months."""
    rng, rows = random.Random(seed), []
    for a in range(accounts):
        away = set(rng.sample(range(1, 7), rng.choice([0, 0, 1, 2])))
        age = rng.randint(0, 100)
        for n in range(181):
            day = dt.date(2022, 1, 1) + dt.timedelta(days=n)
            edge = day.day in (1, 2) or (day + dt.timedelta(days=2)).month != day.month
            if day.month in away or not (edge or rng.random() < 0.15) or rng.random() < 0.1:
                continue
            age = max(0, age + rng.choice([1, 1, 1, 2, -30, 25]))
            shown = rng.choice([age, age, age, age + rng.choice([-40, 40]), None])
            rows.append((f"{a:04d}", day, shown, *[rng.choice([None, n, n]) for n in ("vo", "tv", "bb")], float(rng.randint(1, 5)),
                         day - dt.timedelta(days=rng.randint(0, 200)), day - dt.timedelta(days=rng.randint(0, 40)),
                         day - dt.timedelta(days=rng.randint(60, 120))))
    return rows


@pytest.fixture(scope="module")
def daily(spark):
    snap = spark.createDataFrame(history(), SNAP)
    return rgu_flags(snap).withColumns({
        "num_rgus": rgu_count(), "mix": product_mix(), "tech": tech_flag("PROMO", "MEDIUM"), "bundle": bundle_name(),
        "charge": F.col("bill_amt") * 2, "phone": F.concat(F.lit("2"), "account")}).cache()


def full_run(days, upto):
    """The whole table from all days before the end of a month."""
    seen = days.where(F.col("dt") < F.lit(next_period(upto, 1, "month")))
    return T.fixed_account_table(account_closing(repair_age(seen), "month"), "month").where(F.col("period") == F.lit(upto))


def as_set(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_each_month_from_state_equals_a_full_run(spark, daily):
    state = fixed_state(daily.where(F.col("dt") < F.lit(MONTHS[1])), "month")
    for month in MONTHS[1:] + [dt.date(2022, 7, 1)]:
        expected = full_run(daily, month)
        days = daily.where(period_of(F.col("dt"), "month") == F.lit(month))
        table, after = fixed_period(period_facts(days, "month"), state, month)
        assert sorted(table.columns) == sorted(expected.columns)
        assert as_set(table, expected.columns) == as_set(expected, expected.columns)
        # State after a run is the state found from all days.
        state = spark.createDataFrame(after.collect(), after.schema)
        if month in (MONTHS[2], MONTHS[-1]):
            found = fixed_state(daily.where(F.col("dt") < F.lit(next_period(month, 1, "month"))), "month")
            # The closing row before the last one is only asked for when it is of the adjacent month.
            keep = [c for c in found.columns if c != "before"]
            assert as_set(after, keep) == as_set(found, keep)


def test_runs_read_one_partition_and_refuse_stale_months(spark, daily, tmp_path):
    store = PeriodStore(spark, str(tmp_path / "store"))
    runs = AccountRuns(store)
    runs.start_fixed(MONTHS[1], daily)
    for month in MONTHS[2:4]:
        runs.save_days(month, daily)
    with pytest.raises(NotReady, match="fixed_state 2022-03-01 has no finished run"):
        runs.run_fixed(MONTHS[3])
    runs.run_fixed(MONTHS[2])
    runs.run_fixed(MONTHS[3])
    expected = full_run(daily, MONTHS[3])
    one = store.read("fixed", MONTHS[3], MONTHS[3])
    assert as_set(one, expected.columns) == as_set(expected, expected.columns)
    scanned = store.read("fixed_days", MONTHS[3], MONTHS[3])
    assert scanned.inputFiles() and all("/fixed_days/period=2022-04-01/" in f for f in scanned.inputFiles())
    # New days of March: its own table and all that was built on it are stale until they run again.
    runs.save_days(MONTHS[2], daily.where("account <> '0001'"))
    assert store.problems("fixed", MONTHS[3]) == ["fixed 2022-04-01 is stale: fixed_days 2022-03-01 was run again"]
    with pytest.raises(NotReady):
        runs.run_fixed(MONTHS[3])
    runs.run_fixed(MONTHS[2])
    runs.run_fixed(MONTHS[3])
    assert store.problems("fixed", MONTHS[3]) == []


def test_killed_and_repeated_months(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store, month = PeriodStore(spark, path), MONTHS[0]
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    assert store.save("days", month, frame(1, 2))
    assert store.commits()["days", month].rows == 2
    # A run that dies after writing its rows and before its commit leaves nothing to be read.
    with monkeypatch.context() as patch:
        patch.setattr(PeriodStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.save("days", month, frame(7))
    assert [r.v for r in store.read("days").orderBy("v").collect()] == [1, 2]
    store.save("table", month, frame(3), [("days", month)], {"limit": 90})
    # The same parameters and inputs: nothing to do. Others: written again.
    assert not store.save("table", month, frame(4), [("days", month)], {"limit": 90}, replace=False)
    assert store.save("table", month, frame(4), [("days", month)], {"limit": 92}, replace=False)
    store.save("days", month, frame(5))
    with pytest.raises(NotReady, match="stale"):
        store.read("table")
    assert store.save("table", month, frame(6), [("days", month)], {"limit": 92}, replace=False)
    assert [r.v for r in PeriodStore(spark, path).read("table").collect()] == [6]
    with pytest.raises(NotReady, match="no finished run"):
        store.read("table", MONTHS[1], MONTHS[1])
    # An input that is replaced between reading and saving.
    read = store.runs([("days", month)])
    store.save("days", month, frame(5, 5))
    with pytest.raises(NotReady, match="was run again"):
        store.save("table", month, frame(7), read)
    assert store.save("table", month, frame(6), store.runs([("days", month)]), {"limit": 92})
    # Older months may lack columns.
    store.save("table", MONTHS[1], spark.createDataFrame([(8, "new")], "v int, w string"), [])
    assert as_set(store.read("table"), ["period", "v", "w"]) == [(month, 6, None), (MONTHS[1], 8, "new")]
    assert store.periods("table") == MONTHS[:2]


def test_repair_in_periods_equals_repair_of_all(daily):
    columns = ["account", "dt", "age", "prev_age", "next_age", "is_jump", "age_fix"]
    for strict in (False, True):
        expected = as_set(repair_age(daily, isolated_to_null=strict), columns)
        around = R.halo(R.edges(daily, "month"))
        assert as_set(R.repair_in_periods(daily, around, "month", isolated_to_null=strict), columns) == expected
    # One month alone gives its part of the result.
    month = daily.where(period_of(F.col("dt"), "month") == F.lit(MONTHS[2]))
    part = R.repair_in_periods(month, around, "month", isolated_to_null=True)
    assert as_set(part, columns) == [r for r in expected if r[1].month == 3]


def facts():
    day = F.col("dt")
    return {"first_age": A.first(F.col("age"), day), "last_age": A.last(F.col("age"), day),
            "known": A.first(F.col("age"), day, known=True), "low": A.lowest(F.col("inst_dt")), "high": A.highest(F.col("inst_dt"))}


def test_merged_state_equals_one_pass_with_late_rows(spark, daily, tmp_path):
    keys, store = ["account", "period"], PeriodStore(spark, str(tmp_path / "state"))
    rows = daily.withColumn("period", period_of(F.col("dt"), "month"))
    late = (F.dayofmonth("dt") % 7 == 3) & (F.col("period") >= F.lit(MONTHS[4]))
    store.save_all("state", A.fold(rows.where(~late), keys, facts()))
    runs = {p: c.run for (_, p), c in store.commits().items()}
    late_state = A.fold(rows.where(late), keys, facts())
    A.save_late(store, "state", late_state, keys, facts())
    A.save_late(store, "state", late_state, keys, facts())  # a repeated delivery changes nothing
    expected = A.values(A.fold(rows, keys, facts()), keys, facts())
    assert as_set(A.values(store.read("state"), keys, facts()), expected.columns) == as_set(expected, expected.columns)
    touched = {p for (_, p), c in store.commits().items() if c.run != runs[p]}
    assert touched == set(MONTHS[4:6])
    rolled = A.values(A.merge([store.read("state")], ["account"], facts()), ["account"], facts())
    whole = A.values(A.fold(rows, ["account"], facts()), ["account"], facts())
    assert as_set(rolled, whole.columns) == as_set(whole, whole.columns)


# -- one-pass convergence --------------------------------------------------------------------

FIXED = "period date, fixed_account string, active_bom int, active_eom int"
MOBILE = "period date, mobile_account string, fmc_account string, mobile_active_bom int, mobile_active_eom int"


def test_crowded_keys_give_the_same_rows(spark):
    month = MONTHS[0]
    fixed = spark.createDataFrame([(month, a, 1, 0) for a in ("77", "88", "0000000077", "99")], FIXED)
    mobile = spark.createDataFrame([(month, f"m{i}", "77" if i < 30 else "99" if i == 30 else f"x{i}", 1, 1) for i in range(40)], MOBILE)
    one_pass = C.converge(fixed, mobile)
    columns = one_pass.columns
    # Two accounts share a key: every line of it takes both.
    assert one_pass.count() == 60 + 1 + 9 + 1
    assert as_set(C.converge(fixed, mobile, crowded=["0000000077"]), columns) == as_set(one_pass, columns)
    assert C.crowded_contracts(mobile.withColumnRenamed("fmc_account", "fixed_contract"), share=10) == ["0000000077"]


def test_convergence_computes_each_table_once(spark, folder):
    from abonara.catalog import CASES
    plan = lambda name: CASES[name].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    windows = lambda name: len(re.findall(r"\bWindow \[", plan(name)))
    # Orders: snapshot, mobile lines, mobile movements. Addresses are looked up for both sides.
    converged = plan("fmc_waterfall_labels")
    assert converged.count("orders.parquet") == 3 and converged.count("FileScan parquet") == 7
    # Each window of the two tables once, and the one in which they meet.
    assert windows("fmc_waterfall_labels") == windows("fixed_table") + windows("mobile_table") + 1
