"""Two later forms of the fixed account table: churn from the movement log, and churn from orders.

Both pair closing rows on the unrepaired age with a threshold of 92 days, call a new customer by
the start month, and flag transfers and returning accounts. They differ in where a loss gets its
type. Each account-period row takes all facts of its kind with one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import profile as P
from abonara.functions import values as V
from abonara.functions.calendar import period_of, shift_period
from abonara.functions.rules import first_match
from abonara.operators import churn as E
from abonara.operators import contact as I
from abonara.operators import snapshot as S

COLUMNS = ["num_rgus", "mix", "age", "bill_amt", "tenure", "start_dt", "tech", "vo_nm", "tv_nm", "bb_nm"]
DAYS = 92


def moved_pairs(closing: DataFrame, grain: str, days: int, migrated: DataFrame | None = None) -> DataFrame:
    """Paired closing rows with movement, tenure segments and spin.

    ``migrated`` lists lost account-periods that became business accounts.
    """
    pair = S.pair_closing_rows(closing, COLUMNS, grain, days)
    if migrated is not None:
        pair = pair.join(migrated.withColumn("_to_business", F.lit(1)), E.KEYS, "left")
        moved = S.main_movement(pair, "start_month", F.col("_to_business") == 1).drop("_to_business")
    else:
        moved = S.main_movement(pair, "start_month")
    return moved.withColumns({
        "b_tenure_segment": P.tenure_segment(F.col("b_tenure")), "e_tenure_segment": P.tenure_segment(F.col("e_tenure")),
        "spin": S.spin(F.col("b_bill_amt"), F.col("e_bill_amt"), F.col("main_movement"))})


def _lost() -> Column:
    return (F.col("active_bom") == 1) & (F.col("active_eom") == 0)


def _returned(table: DataFrame, gone: Column, grain: str) -> DataFrame:
    """Flag rows whose account was gone in the period before; one look back per account."""
    before = F.lag(F.struct("period", gone.alias("gone"))).over(Window.partitionBy("account").orderBy("period"))
    adjacent = (shift_period(F.col("_p.period"), 1, grain) == F.col("period")) & F.col("_p.gone")
    return table.withColumn("_p", before).withColumn("rejoiner_flag", F.when(adjacent, "Rejoiner")).drop("_p")


def log_fixed_table(closing: DataFrame, log: DataFrame, migrated: DataFrame, grain: str = "month", days: int = DAYS) -> DataFrame:
    """Fixed table whose losses are typed by the last entry of the movement log in the period.

    An account is a rejoiner when it was lost in the period before, whatever the log says.
    """
    moves = E.contract_movements(log, grain)
    rows = moved_pairs(closing, grain, days, migrated).withColumn("key", P.last10(F.col("account")))
    known = rows.join(moves, ["key", "period"], "left").join(E.transfer_balance(log), "key", "left")
    reason = P.movement_reason(F.col("last_code"), F.col("last_kind"), F.col("last_description"))
    # The entry that types a loss lies in the period itself; transfers may use the day before it.
    dated = period_of(F.col("last_day"), grain) == F.col("period")
    typed = known.withColumn("churn_type", F.when(_lost() & dated, reason)).withColumn("transfer_flag", E.transfer_rule())
    return _returned(typed, _lost(), grain).drop("key", *[c for c in moves.columns if c not in ("key", "period")], "balance")


def order_marks(daily: DataFrame, orders: DataFrame, grain: str, days: int) -> dict[str, DataFrame]:
    """Account-periods that reached the threshold, had a disconnect order, or were cut off for debt."""
    by = lambda day: period_of(F.col(day), grain).alias("period")
    reached = daily.where(F.col("age") >= days).select("account", by("dt"))
    leaving = orders.where(F.col("order_type") == V.DEINSTALL)
    return {"reached": reached, "ordered": leaving.select("account", by("start")),
            "early": leaving.where(F.col("command").isin(*V.DELINQUENCY_CODES)).select("account", by("start"))}


def order_fixed_table(closing: DataFrame, daily: DataFrame, orders: DataFrame, grain: str = "month", days: int = DAYS) -> DataFrame:
    """Fixed table whose losses are typed by age and disconnect orders.

    A loss that neither reached the threshold nor has an order is voluntary. Of the others a
    delinquency-coded order makes it an early disconnection, else the threshold makes it
    involuntary. Rejoiners are the losses of the period before by movement.
    """
    rows = I.attach_flags(moved_pairs(closing, grain, days), order_marks(daily, orders, grain, days))
    has = lambda c: F.col(c).isNotNull()
    kind = first_match([
        (~has("reached") & ~has("ordered"), V.FIXED_VOLUNTARY), (has("early"), V.FIXED_EARLY),
        (has("reached"), V.FIXED_INVOLUNTARY)], V.FIXED_VOLUNTARY)
    typed = rows.withColumn("churn_type", F.when(_lost(), kind)).drop("reached", "ordered", "early")
    flagged = E.transfer_flag_by_orders(typed, orders, grain)
    churned = F.col("churn_type").isin(V.FIXED_VOLUNTARY, V.FIXED_INVOLUNTARY)
    return _returned(flagged, F.col("main_movement") == V.LOSS, grain).withColumn(
        "rgu_churn", F.when(churned, F.col("b_num_rgus"))
        .when(F.col("main_movement") == V.DOWNSELL, F.col("b_num_rgus") - F.col("e_num_rgus")).otherwise(0))
