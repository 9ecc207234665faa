"""Runs of single periods from saved state, repair across period edges, merged first/last state."""

from uuid import uuid4

from pyspark.sql import functions as F

from abonara.catalog import contact, converge  # noqa: F401  (their fragments are needed)
from abonara.catalog.base_sql import mth, q
from abonara.catalog.registry import as_of, case
from abonara.functions.calendar import period_of
from abonara.operators import contact as I
from abonara.operators import partials as A
from abonara.operators import repair as R
from abonara.operators.bitmaps import DistinctCube
from abonara.plans import drivers as D
from abonara.plans import tables as T
from abonara.plans.periods import AccountRuns, next_period
from abonara.session import ensure_checkpoint_dir
from abonara.sources.commits import PeriodStore


def new_store(inputs, name):
    return PeriodStore(inputs.spark, f"{ensure_checkpoint_dir(inputs.spark)}/{name}_{uuid4().hex}")


def last_period(inputs):
    """First day of the last quarter with orders."""
    return inputs.table("orders").agg(period_of(F.to_date(F.max("o_orderdate")), T.GRAIN)).first()[0]


LAST = f"(SELECT {q('max(o_orderdate)')} FROM orders)"
PREVIOUS = f"(SELECT CAST({q('max(o_orderdate)')} - INTERVAL '3' MONTH AS DATE) FROM orders)"


def fixed_runs(inputs):
    """State from all days before the last two periods, then one run for each of these."""
    runs, last = AccountRuns(new_store(inputs, "account_runs"), T.GRAIN), last_period(inputs)
    periods = [next_period(last, -1, T.GRAIN), last]
    runs.start_fixed(next_period(last, -2, T.GRAIN), inputs.profiled)
    for period in periods:
        runs.save_days(period, inputs.profiled)
        runs.run_fixed(period)
    return runs, periods


fixed_before = as_of("fixed_table", "snap", f"dt < {LAST}", "_before")


@case("fixed_periods_from_saved_state", "A4 A5 D1 D2 D3 D4 E1 E4 E12 E14", f"fixed_table {fixed_before}", f"""
  SELECT * FROM {fixed_before} WHERE period = {PREVIOUS}
  UNION ALL BY NAME SELECT * FROM fixed_table WHERE period = {LAST}""")
def _(inputs):
    runs, periods = fixed_runs(inputs)
    return runs.store.read("fixed", *periods)


def mobile_runs(inputs, runs, periods):
    runs.start_mobile(next_period(periods[0], -1, T.GRAIN), T.mobile_table(inputs))
    for period in periods:
        runs.save_mobile(period, inputs.mobile_closing, T.typed_moves(inputs))
        runs.run_mobile(period)


@case("mobile_periods_from_saved_state", "A4 D6 E11 E12", "mobile_table", f"""
  SELECT * FROM mobile_table WHERE period IN ({PREVIOUS}, {LAST})""")
def _(inputs):
    runs, last = AccountRuns(new_store(inputs, "mobile_runs"), T.GRAIN), last_period(inputs)
    periods = [next_period(last, -1, T.GRAIN), last]
    mobile_runs(inputs, runs, periods)
    return runs.store.read("mobile", *periods)


_fmc_columns = """period, final_account, fixed_account, mobile_account, copies, b_fmc_type, e_fmc_type, b_fmc_segment,
  e_fmc_segment, final_churn_flag, final_churn_type, rejoiner_flag, waterfall"""


@case("converged_period_from_saved_tables", "A4 F2 F3 F4 F6 F7 F9 F10 F11", "fmc_table", f"""
  SELECT {_fmc_columns} FROM fmc_table WHERE period = {LAST}""")
def _(inputs):
    runs, periods = fixed_runs(inputs)
    mobile_runs(inputs, runs, periods[1:])
    runs.run_converged(periods[1], inputs.fixed_emails)
    return runs.store.read("converged", *periods[1:] * 2).select(*[c.strip() for c in _fmc_columns.split(",")])


@case("repaired_ages_in_periods", "C3", "repaired", """
  SELECT account, dt, age, prev_age, next_age, is_jump, age_fix FROM repaired""")
def _(inputs):
    days = inputs.snap.select("account", "dt", "age")
    around = R.halo(R.edges(days, "month"))
    return R.repair_in_periods(days, around, "month").select(
        "account", "dt", "age", "prev_age", "next_age", "is_jump", "age_fix")


# -- merged first/last state ----------------------------------------------------------------


def period_state():
    day = F.col("dt")
    return {"first_dt": A.lowest(day), "last_dt": A.highest(day), "first_age": A.first(F.col("age"), day),
            "last_age": A.last(F.col("age"), day), "last_unpaid_days": A.last(F.datediff("dt", "unpaid_dt"), day),
            "first_known_age": A.first(F.col("age"), day, known=True),
            "last_known_bb": A.last(F.col("bb_nm"), day, known=True),
            "first_inst_dt": A.lowest(F.col("inst_dt")), "max_inst_dt": A.highest(F.col("inst_dt")),
            "first_bill_dt": A.first(F.col("bill_dt"), day, known=True)}


def merged_state(inputs):
    """Saved state of the rows that came in time; pending orders come late and are merged in."""
    store, keys, facts = new_store(inputs, "period_state"), ["account", "period"], period_state()
    rows = inputs.snap.withColumn("period", period_of(F.col("dt"), T.GRAIN))
    on_time, late = (A.fold(rows.where(c), keys, facts) for c in ("status <> 'P'", "status = 'P'"))
    store.save_all("first_last", on_time)
    A.save_late(store, "first_last", late, keys, facts)
    return store.read("first_last")


def _facts_sql(keys, partition):
    first = lambda c, cond="true": f"arg_min_null({c}, dt) FILTER ({cond})"
    last = lambda c, cond="true": f"arg_max_null({c}, dt) FILTER ({cond})"
    return f"""
  SELECT {keys}, min(dt) AS first_dt, max(dt) AS last_dt, {first('age')} AS first_age, {last('age')} AS last_age,
    CAST({last('dt - unpaid_dt')} AS INTEGER) AS last_unpaid_days, {first('age', 'age IS NOT NULL')} AS first_known_age,
    {last('bb_nm', 'bb_nm IS NOT NULL')} AS last_known_bb, min(inst_dt) AS first_inst_dt, max(inst_dt) AS max_inst_dt,
    {first('bill_dt', 'bill_dt IS NOT NULL')} AS first_bill_dt
  FROM snap GROUP BY {partition}"""


@case("account_periods_from_merged_state", "C2 E3", "snap", _facts_sql(f"account, {q('dt')} AS period", f"account, {q('dt')}"))
def _(inputs):
    return A.values(merged_state(inputs), ["account", "period"], period_state())


@case("accounts_from_merged_state", "C1 G3 G7 G8", "snap", _facts_sql("account", "account"))
def _(inputs):
    facts = period_state()
    return A.values(A.merge([merged_state(inputs)], ["account"], facts), ["account"], facts)


# -- distinct counts from stored bitmaps ------------------------------------------------------


def _cube_levels(cube, dim):
    """Weeks by the dimension, months by the dimension, and months over all, from the same bitmaps."""
    month = F.trunc("period", "month")
    levels = {"week": {"period": F.col("period"), dim: F.col(dim)}, "month": {"period": month, dim: F.col(dim)},
              "month, all": {"period": month}}
    frames = [cube.counts(by).withColumn("level", F.lit(name)) for name, by in levels.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2], allowMissingColumns=True)


def _cube_sql(source, flags, where):
    counted = "count(DISTINCT account) AS active_base, " + ", ".join(f"count(DISTINCT {f}) AS {f}" for f in flags)
    part = lambda level, period, segment: (
        f"SELECT '{level}' AS level, {period} AS period, {segment} AS segment, {counted} FROM {source} WHERE {where} GROUP BY ALL")
    return " UNION ALL ".join([part("week", "period", "segment"), part("month", mth("period"), "segment"),
                               part("month, all", mth("period"), "CAST(NULL AS VARCHAR)")])


_staying = "final_churn_flag NOT IN ('Fixed Churner', 'Full Churner')"


def _flags_of(names):
    return {"active_base": F.lit(True)} | {n: F.col(n).isNotNull() for n in names}


@case("driver_cube_from_bitmaps", "I13", "drivers", _cube_sql("drivers", D.DRIVER_FLAGS, _staying))
def _(inputs):
    cube = DistinctCube(new_store(inputs, "driver_cube"), "drivers", ["segment"], _flags_of(D.DRIVER_FLAGS))
    cube.add(I.without_churners(D.driver_table(inputs)))
    return _cube_levels(cube, "segment")


@case("contact_cube_from_bitmaps", "I14", "contact_flags", _cube_sql("contact_flags", D.CONTACT_FLAGS, _staying))
def _(inputs):
    cube = DistinctCube(new_store(inputs, "contact_cube"), "contacts", ["segment"], _flags_of(D.CONTACT_FLAGS))
    cube.add(I.without_churners(D.contact_table(inputs)))
    return _cube_levels(cube, "segment")


_YEAR = "CAST(date_trunc('year', period) AS DATE)"
_both = "count(DISTINCT account) AS accounts, count(DISTINCT CASE WHEN active_bom = 1 THEN account END) AS at_start, " \
        "count(DISTINCT CASE WHEN active_eom = 1 THEN account END) AS at_end"


@case("movement_cube_from_bitmaps", "D8 K6", "moved", f"""
  SELECT 'quarter' AS level, period, main_movement, {_both} FROM moved GROUP BY ALL
  UNION ALL SELECT 'year', {_YEAR}, main_movement, {_both} FROM moved GROUP BY ALL
  UNION ALL SELECT 'year, all', {_YEAR}, NULL, {_both} FROM moved GROUP BY ALL""")
def _(inputs):
    cube = DistinctCube(new_store(inputs, "movement_cube"), "movements", ["main_movement"], {
        "accounts": F.lit(True), "at_start": F.col("active_bom") == 1, "at_end": F.col("active_eom") == 1})
    cube.add(T.movements(inputs))
    year, movement = F.trunc("period", "year"), F.col("main_movement")
    levels = {"quarter": {"period": F.col("period"), "main_movement": movement}, "year": {"period": year, "main_movement": movement},
              "year, all": {"period": year}}
    frames = [cube.counts(by).withColumn("level", F.lit(name)) for name, by in levels.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2], allowMissingColumns=True)
