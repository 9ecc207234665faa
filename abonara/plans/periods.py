"""The account tables one period at a time, from saved state.

A full run reads all history to make any period. Here a run reads the days of its own period and
one state row per account, and writes the period's table and the next state:

    runs = AccountRuns(PeriodStore(spark, folder))
    runs.start_fixed(period, history)       # once, from the days up to the end of a period
    runs.save_days(later, days)             # the daily snapshot as it arrives
    runs.run_fixed(later)                   # account table and state of that period

The result is the period's rows of a full run over the days up to the period's end. What such a run
knows about earlier records is in the state: the last closing row with the age before it (a jump
at the edge of a period can only be told when the next record arrives), the closing row of the
period before that, and the account's firsts. Every run is committed with the runs it read (see
``sources.commits``), so a period built on days or state that were replaced is refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import complete_months, in_period, period_of, shift_period
from abonara.functions.profile import flag
from abonara.operators import churn as E
from abonara.operators import snapshot as S
from abonara.operators.dedup import repair_age, repaired_age
from abonara.plans import tables as T
from abonara.session import written
from abonara.sources.commits import PeriodStore

#: Columns of a closing row that the account table and later runs ask for.
ROW = ["dt", "age", "unpaid_dt", "last_pay_dt", "held_rgus"] + [
    c for c in T.PAIR_COLUMNS if c not in ("age", "age_fix", "tenure", "start_dt", "max_inst_dt")]


def next_period(period: date, n: int, grain: str) -> date:
    """The period ``n`` periods on, for whole-month grains."""
    months = period.year * 12 + period.month - 1 + n * {"month": 1, "quarter": 3}[grain]
    return date(months // 12, months % 12 + 1, 1)


# -- fixed accounts ----------------------------------------------------------------------


def period_facts(days: DataFrame, grain: str, *more: str) -> DataFrame:
    """Per account (and period) of daily rows: the last row, the record before it, and the period's firsts.

    ``more``: further columns of the last row to keep.
    """
    along = Window.partitionBy("account").orderBy("dt")
    rows = days.withColumns({"_before": F.struct(F.lag("dt").over(along).alias("dt"), F.lag("age").over(along).alias("age"))})
    kept = [c for c in ROW if c != "held_rgus"] + list(more)
    facts = rows.groupBy("account", period_of(F.col("dt"), grain).alias("period")).agg(
        F.max_by(F.struct(*kept, "_before"), "dt").alias("last"), S.held_lines().alias("held_rgus"),
        F.min("dt").alias("first_dt"), F.min_by("age", "dt").alias("first_age"),
        F.max("inst_dt").alias("max_inst_dt"), F.min_by(S.named_lines(), "dt").alias("first_rgus"))
    return facts.select(
        "account", "period", F.struct(*[F.col(f"last.{c}") if c != "held_rgus" else F.col(c) for c in ROW]).alias("last"),
        *[F.col(f"last.{c}").alias(c) for c in more], F.col("last._before").alias("before_last"), "first_dt", "first_age", "max_inst_dt", "first_rgus")


STATE = ["account", "closed", "last", "prev_age", "before", "start_dt", "max_inst_dt", "first_rgus"]


def _mark(period: Column, day: Column, age: Column, unpaid_dt: Column) -> Column:
    """What a later run asks about the closing row before the last one."""
    return F.struct(period.alias("period"), day.alias("date"), age.alias("age"), F.datediff(day, unpaid_dt).alias("unpaid"))


def fixed_state(history: DataFrame, grain: str = "month") -> DataFrame:
    """State after ``history``, daily rows up to the end of some period: one row per account."""
    closing = period_facts(repair_age(history), grain, "age_fix")
    along, whole = Window.partitionBy("account").orderBy("period"), Window.partitionBy("account")
    before = F.lag(_mark(F.col("period"), F.col("last.dt"), F.col("age_fix"), F.col("last.unpaid_dt"))).over(along)
    rows = closing.select(
        "account", F.col("period").alias("closed"), "last", F.col("before_last.age").alias("prev_age"), before.alias("before"),
        F.min("first_dt").over(whole).alias("start_dt"), F.max("max_inst_dt").over(whole).alias("max_inst_dt"),
        F.min_by("first_rgus", "first_dt").over(whole).alias("first_rgus"), F.lead("period").over(along).alias("_later"))
    return rows.where("_later IS NULL").select(*STATE)


def _closing(prefix: str, there: Column, row: str, age_fix: Column, start: Column, inst: Column, rgus: Column) -> list[Column]:
    day = F.col(f"{row}.dt")
    named = {c: F.col(f"{row}.{c}") for c in ROW} | {
        "date": day, "age_fix": age_fix, "_unpaid": F.datediff(day, F.col(f"{row}.unpaid_dt")), "start_dt": start,
        "max_inst_dt": inst, "first_rgus": rgus, "tenure": complete_months(start, day)}
    return [F.when(there, named[c]).alias(f"{prefix}_{c}") for c in ("date", *T.FIXED_COLUMNS)]


def fixed_period(facts: DataFrame, state: DataFrame, period: date, grain: str = "month", max_age: int = 90):
    """One period of the fixed account table, and the state after it.

    ``facts`` are the :func:`period_facts` of the period's profiled days, ``state`` the state of the
    period before. Both have one row per account when they meet, so the join multiplies nothing.
    """
    this = F.lit(period).cast("date")
    previous, before_that = shift_period(this, -1, grain), shift_period(this, -2, grain)
    facts = facts.select("account", *[F.col(c).alias(f"now_{c}") for c in (
        "last", "before_last", "first_dt", "first_age", "max_inst_dt", "first_rgus")])
    met = facts.join(state, "account", "full")
    seen, known = F.col("now_last").isNotNull(), F.col("last").isNotNull()
    # The first record of this period settles whether the last one known was a jump or a gap.
    settled = repaired_age(F.col("last.age"), F.col("prev_age"), F.col("now_first_age"))
    start = F.coalesce("start_dt", "now_first_dt")
    inst = F.greatest("max_inst_dt", "now_max_inst_dt")
    rgus = F.coalesce("first_rgus", "now_first_rgus")
    opens = F.coalesce(known & (F.col("closed") == previous), F.lit(False))
    lapsed = F.coalesce(known & (F.col("closed") == before_that), F.lit(False))

    # The loss of the period before: its closing row is the last one, or it has none.
    last = [F.col("last.dt"), settled, F.datediff("last.dt", F.col("last.unpaid_dt"))]
    follows = F.col("before.period") == before_that
    earlier = [F.when(follows, F.col(f"before.{c}")) for c in ("date", "age", "unpaid")]
    nothing = [F.lit(None).cast(t) for t in ("date", "int", "int")]
    loss_before = F.when(opens, T.fixed_loss(earlier, last, max_age)).when(lapsed, T.fixed_loss(last, nothing, max_age))

    pairs = met.where(seen | opens).select(
        this.alias("period"), "account", loss_before.alias("_loss_before"),
        *_closing("b", opens, "last", settled, start, inst, rgus),
        *_closing("e", seen, "now_last", F.col("now_last.age"), start, inst, rgus))
    table = T.finished_fixed(T.typed_fixed(pairs, max_age, grain), F.col("_loss_before")).drop("_loss_before")

    age_before = F.when(F.col("now_before_last.dt").isNotNull(), F.col("now_before_last.age")).otherwise(F.col("last.age"))
    after = met.select(
        "account", F.when(seen, this).otherwise(F.col("closed")).alias("closed"), F.coalesce("now_last", "last").alias("last"),
        F.when(seen, age_before).otherwise(F.col("prev_age")).alias("prev_age"),
        F.when(seen, F.when(known, _mark(F.col("closed"), F.col("last.dt"), settled, F.col("last.unpaid_dt"))))
        .otherwise(F.col("before")).alias("before"),
        start.alias("start_dt"), inst.alias("max_inst_dt"), rgus.alias("first_rgus"))
    return table, after


# -- mobile lines ------------------------------------------------------------------------

LINE = ["fixed_contract", "mrc", "start_dt", "email"]


def mobile_state(lines: DataFrame) -> DataFrame:
    """State after the first period there is: every line of it, none of them lost."""
    return lines.select("mobile_account", F.struct(*LINE).alias("line"), F.lit(None).cast("string").alias("churn_type"))


def mobile_period(lines: DataFrame, state: DataFrame, moves: DataFrame, period: date, grain: str = "month"):
    """One period of the mobile table, and the state after it.

    ``lines`` has one row per mobile account of the period, ``moves`` the typed movements of it. The
    state has the accounts of the period before: their row, null if lost, and their churn type.
    """
    now = lines.select("mobile_account", F.struct(*LINE).alias("now"))
    met = now.join(state, "mobile_account", "full").where("now IS NOT NULL OR line IS NOT NULL")
    side = lambda s, row: [F.col(f"{row}.{c}").alias(f"{s}_{c}") for c in LINE]
    pair = met.select(
        F.lit(period).cast("date").alias("period"), "mobile_account", flag(F.col("line").isNotNull()).alias("active_bom"),
        flag(F.col("now").isNotNull()).alias("active_eom"), *side("b", "line"), *side("e", "now"),
        F.col("churn_type").alias("_type_before"), "now")
    typed = E.mobile_churn(T.labelled_mobile(pair), moves, grain)
    table = typed.withColumn("mobile_rejoiner_type", E.type_labels(V.MOBILE_REJOINERS, F.col("_type_before")))
    after = table.select("mobile_account", F.col("now").alias("line"), F.col("mobile_churn_type").alias("churn_type"))
    return table.drop("_type_before", "now"), after


# -- saved runs --------------------------------------------------------------------------


class AccountRuns:
    """Saved runs of the fixed, mobile and converged tables, one period each.

    Tables of the store: ``fixed_days``, ``mobile_lines``, ``mobile_moves`` (inputs),
    ``fixed_state``, ``mobile_state``, and the results ``fixed``, ``mobile`` and ``converged``.
    """

    def __init__(self, store: PeriodStore, grain: str = "month", max_age: int = 90):
        self.store, self.grain, self.max_age = store, grain, max_age

    def _before(self, period: date) -> date:
        return next_period(period, -1, self.grain)

    def _one(self, name: str, period: date) -> DataFrame:
        return self.store.read(name, period, period).drop("period")

    def _save(self, name: str, period: date, rows: DataFrame, used: Sequence[tuple[str, date, str]]) -> None:
        rows = rows.drop("period")
        self.store.save(name, period, rows, used, {"grain": self.grain, "max_age": self.max_age})

    def _inside(self, day: str, period: date) -> Column:
        return in_period(F.col(day), F.lit(period).cast("date"), self.grain)

    def save_days(self, period: date, days: DataFrame) -> None:
        """Save or replace the profiled daily rows of a period; other days are not taken."""
        self.store.save("fixed_days", period, days.where(self._inside("dt", period)))

    def save_mobile(self, period: date, lines: DataFrame, moves: DataFrame) -> None:
        """Save or replace the mobile lines (with their ``period``) and typed movements of a period."""
        self.store.save("mobile_lines", period, lines.where(F.col("period") == F.lit(period).cast("date")).drop("period"))
        self.store.save("mobile_moves", period, moves.where(self._inside("day", period)))

    def start_fixed(self, period: date, history: DataFrame) -> None:
        """State at the end of ``period`` from profiled daily rows; later days are not read."""
        upto = history.where(F.col("dt") < shift_period(F.lit(period).cast("date"), 1, self.grain))
        self.store.save("fixed_state", period, fixed_state(upto, self.grain))

    def start_mobile(self, period: date, table: DataFrame) -> None:
        """State at the end of ``period`` from the period's rows of a mobile table."""
        rows = table.where(F.col("period") == F.lit(period).cast("date"))
        self.store.save("mobile_state", period, rows.select(
            "mobile_account", F.when(F.col("active_eom") == 1, F.struct(*[F.col(f"e_{c}").alias(c) for c in LINE])).alias("line"),
            F.col("mobile_churn_type").alias("churn_type")))

    def run_fixed(self, period: date) -> None:
        """Fixed table and state of one period; reads its days and the state before it."""
        used = self.store.runs([("fixed_days", period), ("fixed_state", self._before(period))])
        days, state = (self._one(*u[:2]) for u in used)
        # Both results need the facts, one row per account: written once.
        facts = written(period_facts(days, self.grain), "fixed_facts")
        table, after = fixed_period(facts, state, period, self.grain, self.max_age)
        self._save("fixed", period, table, used)
        self._save("fixed_state", period, after, used)

    def run_mobile(self, period: date) -> None:
        """Mobile table and state of one period; reads its lines and movements and the state before it."""
        used = self.store.runs([("mobile_lines", period), ("mobile_moves", period), ("mobile_state", self._before(period))])
        lines, moves, state = (self._one(*u[:2]) for u in used)
        table, after = mobile_period(lines, state, moves, period, self.grain)
        self._save("mobile", period, table, used)
        self._save("mobile_state", period, after, used)

    def run_converged(self, period: date, emails: DataFrame) -> None:
        """Converged table of one period from the saved fixed and mobile tables."""
        used = self.store.runs([("fixed", period), ("mobile", period)])
        fixed, mobile = (self.store.read(name, when, when) for name, when, _ in used)
        self._save("converged", period, T.labelled_fmc(fixed, T.near_lines(mobile, emails)), used)
