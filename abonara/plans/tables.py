"""The account-period tables: fixed, mobile and converged.

Each is one chain from inputs to a business table. They are the natural points to write
a month partition with :func:`abonara.sources.tables.save_periods`; until then they are
lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import profile as P
from abonara.functions import values as V
from abonara.functions.calendar import complete_months, period_of, shift_period
from abonara.operators import churn as E
from abonara.operators import converge as C
from abonara.operators import converge_phone as CP
from abonara.operators import dedup as D
from abonara.operators import snapshot as S
from abonara.plans.fixtures import Inputs

GRAIN = "quarter"
PAIR_COLUMNS = ["num_rgus", "mix", "age", "age_fix", "bill_amt", "vo_nm", "tv_nm", "bb_nm", "tenure",
                "start_dt", "max_inst_dt", "tech", "bundle", "charge", "phone"]


def pairs(inputs: Inputs) -> DataFrame:
    return S.pair_closing_rows(inputs.closing, PAIR_COLUMNS, GRAIN, 90, "age_fix", "unpaid_dt")


def movements(inputs: Inputs) -> DataFrame:
    return S.main_movement(pairs(inputs))


def migrations(inputs: Inputs) -> DataFrame:
    kinds = inputs.closing.select(
        "account", "period",
        F.when(F.col("priority") == "1-URGENT", "B2B").otherwise("B2C").alias("kind"))
    before = kinds.withColumn("period", shift_period(F.col("period"), 1, GRAIN))
    return S.segment_migration(before, kinds, ["period", "account"])


def mobile_pairs(inputs: Inputs) -> DataFrame:
    columns = ["fixed_contract", "mrc", "start_dt", "email"]
    rows = inputs.mobile_closing.select(
        "period", F.col("mobile_account").alias("account"), "dt", F.lit(None).cast("int").alias("age"),
        *columns)
    return (S.pair_closing_rows(rows, columns, GRAIN)
            .withColumnRenamed("account", "mobile_account").drop("b_date", "e_date"))


def labelled_mobile(pair: DataFrame) -> DataFrame:
    """Movement, convergence key and tenure of mobile pairs."""
    segment = lambda s: P.mobile_tenure_segment(complete_months(F.col(f"{s}_start_dt"), F.col("period")))
    return S.mobile_movement(pair).withColumns({"b_mobile_tenure": segment("b"), "e_mobile_tenure": segment("e")})


def mobile_movements(inputs: Inputs) -> DataFrame:
    return labelled_mobile(mobile_pairs(inputs))


def typed_moves(inputs: Inputs) -> DataFrame:
    """Mobile movement file with the churn type of each movement."""
    reason = P.mobile_movement_reason(*[F.col(c) for c in ("movement", "leave_kind", "migration_kind")])
    return inputs.mobile_moves.withColumn("churn_type", reason)


def repaired(inputs: Inputs) -> DataFrame:
    return D.repair_age(inputs.profiled)


def brackets(inputs: Inputs) -> DataFrame:
    return E.record_brackets(repaired(inputs), GRAIN)


def mobile_table(inputs: Inputs) -> DataFrame:
    """Mobile account-period table with movement, churn and rejoiner columns."""
    return E.mobile_rejoiners(E.mobile_churn(mobile_movements(inputs), typed_moves(inputs), GRAIN), GRAIN)


FIXED_COLUMNS = PAIR_COLUMNS + ["last_pay_dt", "_unpaid", "held_rgus", "first_rgus"]


def in_base(date: Column, age: Column, unpaid: Column, days: int, inclusive: bool) -> Column:
    """Is the account of a closing row part of the base? An unknown age counts as paying."""
    below = (lambda c: c <= days) if inclusive else (lambda c: c < days)
    return F.coalesce(date.isNotNull() & (age.isNull() | below(age) | below(unpaid)), F.lit(False))


def fixed_loss(b: Sequence[Column], e: Sequence[Column], days: int) -> Column:
    """Churn type of an account-period from date, age and unpaid days of its two closing rows.

    Below the threshold at the start and at or above it at the end is the involuntary rule.
    """
    crossed = F.coalesce(E.crossed(b[1], b[2], e[1], e[2], days), F.lit(False))
    return F.when(~in_base(*e, days, True), F.when(crossed, V.FIXED_INVOLUNTARY)
                  .when(in_base(*b, days, False), V.FIXED_VOLUNTARY))


def _marks(side: str) -> list[Column]:
    return [F.col(f"{side}_{c}") for c in ("date", "age_fix", "_unpaid")]


def typed_fixed(state: DataFrame, days: int, grain: str) -> DataFrame:
    """Active flags, movement and churn type of paired closing rows.

    A side that is over the threshold is not part of the base: its columns become null.
    """
    e_age = F.col("e_age_fix")
    pair = state.withColumns({
        "active_bom": P.flag(in_base(*_marks("b"), days, False)), "active_eom": P.flag(in_base(*_marks("e"), days, True)),
        "churn_type": fixed_loss(_marks("b"), _marks("e"), days),
        "_paying": F.coalesce((e_age <= days) | (e_age.isNull() & (
            period_of(F.col("e_last_pay_dt"), grain) == F.col("period"))), F.lit(False)),
    })
    pair = pair.withColumns(
        {f"b_{c}": F.when(F.col("active_bom") == 1, F.col(f"b_{c}")) for c in PAIR_COLUMNS}
        | {f"e_{c}": F.when(F.col("active_eom") == 1, F.col(f"e_{c}")) for c in PAIR_COLUMNS})
    return S.main_movement(pair)


def finished_fixed(typed: DataFrame, loss_before: Column) -> DataFrame:
    """The account table from typed pairs; ``loss_before`` is the churn type of the period before."""
    typed = typed.withColumn("rejoiner_type", F.when(F.col("_paying"), E.type_labels(V.FIXED_REJOINERS, loss_before)))
    first_rgus = F.coalesce("b_first_rgus", "e_first_rgus")
    return (
        typed.where("active_bom = 1 OR active_eom = 1 OR churn_type IS NOT NULL")
        .withColumns({
            "spin": S.spin(F.col("b_bill_amt"), F.col("e_bill_amt"), F.col("main_movement")),
            "b_tenure_segment": P.tenure_segment(F.col("b_tenure")),
            "e_tenure_segment": P.tenure_segment(F.col("e_tenure")),
            "rgu_churn": E.rgu_churn(F.col("churn_type"), F.col("main_movement"), F.col("e_held_rgus"),
                                     first_rgus, F.col("b_num_rgus"), F.col("e_num_rgus")),
            "b_plan": P.plan_fingerprint("b_"), "e_plan": P.plan_fingerprint("e_"),
        })
        .drop("_paying", *[f"{s}_{c}" for s in "be" for c in ("_unpaid", "last_pay_dt", "held_rgus", "first_rgus")]))


def fixed_account_table(closing: DataFrame, grain: str = GRAIN, days: int = 90) -> DataFrame:
    """Fixed account-period table from :func:`snapshot.account_closing` rows.

    A closing row holds, for its account and period, the state that every later rule asks about, so
    churn and rejoiner types are found on the pair itself, and the type of the previous period on
    the opening row and the closing row before it. The snapshot is read once and sorted once.
    """
    marks = ("date", "age_fix", "_unpaid")
    rows = closing.withColumns({"date": F.col("dt"), "_unpaid": F.datediff("dt", "unpaid_dt")})
    state = S.pair_closing_rows(rows, FIXED_COLUMNS, grain, max_age=None, earlier=marks)
    loss_before = fixed_loss(_marks("p"), _marks("b"), days)
    state = state.withColumn("_loss_before", F.when(F.col("period").isNotNull(), loss_before)).drop(*[f"p_{c}" for c in marks])
    return finished_fixed(typed_fixed(state, days, grain), F.col("_loss_before")).drop("_loss_before")


def fixed_table(inputs: Inputs, days: int = 90) -> DataFrame:
    """Fixed account-period table of the supplied tables."""
    return fixed_account_table(inputs.closing, GRAIN, days)


def near_lines(mobile: DataFrame, emails: DataFrame) -> DataFrame:
    """Mobile table with the near-FMC columns and names that do not clash."""
    mobile = (mobile.withColumnsRenamed({"active_bom": "mobile_active_bom", "active_eom": "mobile_active_eom"})
              .drop("b_start_dt", "e_start_dt"))
    return C.near_fmc(mobile, emails)


def near_mobile(inputs: Inputs) -> DataFrame:
    return near_lines(mobile_table(inputs), inputs.fixed_emails)


def converged(inputs: Inputs) -> DataFrame:
    return C.converge(fixed_table(inputs).withColumnRenamed("account", "fixed_account"), near_mobile(inputs))


FMC_STEPS = (C.fmc_status, C.fmc_type, C.final_flags, C.fmc_segment, C.final_churn, C.totals,
             C.final_rejoiner, C.partial_total, C.waterfall, C.splits)


def labelled_fmc(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Converged table with every label of the waterfall from the fixed table and :func:`near_lines`."""
    df = C.converge(fixed.withColumnRenamed("account", "fixed_account"), mobile)
    for step in FMC_STEPS:
        df = step(df)
    return df


def fmc_table(inputs: Inputs) -> DataFrame:
    """Converged account-period table of the supplied tables."""
    return labelled_fmc(fixed_table(inputs), near_mobile(inputs))


REAL_CODES = ("PROMO-1", "LARGE-2", "LARGE-3")


def phone_fixed(inputs: Inputs) -> DataFrame:
    """Fixed table in the layout of the phone-matched market."""
    churn, movement = F.col("churn_type"), F.col("main_movement")
    number = lambda n: F.concat(F.lit("7"), F.lpad((F.col("account").cast("long") + n).cast("string"), 9, "0"))
    columns = {
        "fixed_account": F.col("account"), "phone1": number(0), "phone2": number(1),
        "fix_churn_flag": F.when(churn.isNotNull(), CP.FIXED_CHURNER).otherwise(CP.FIXED_STAYER),
        "fix_churn_type": F.when((churn == V.FIXED_VOLUNTARY) & (F.col("b_mix") == "0P"), CP.ZERO_P)
        .when((churn == V.FIXED_VOLUNTARY) & (F.col("b_mix") == "3P"), CP.TRANSFER).otherwise(churn),
        "fix_movement": F.when(movement == V.NEW, CP.NEW).when(movement == V.COME_BACK, CP.BACK)
        .when(movement == V.LOSS, CP.NULL_LAST_DAY).when(movement == V.MISSING, CP.TRANSFER_ADD),
        "fix_rejoiner": P.flag(F.col("rejoiner_type").isNotNull()),
        "fix_e_start": F.when(F.col("e_tech") == "FTTH", F.col("e_start_dt")),
    }
    for s, when in (("b", "bom"), ("e", "eom")):
        columns |= {
            f"fix_{s}_active": F.col(f"active_{when}"), f"fix_{s}_tenure": F.replace(
                F.col(f"{s}_tenure_segment"), F.lit(" "), F.lit("-")),
            f"fix_{s}_mrc": F.round(f"{s}_bill_amt", 0), f"fix_{s}_rgus": F.col(f"{s}_num_rgus"),
            f"fix_{s}_mix": F.col(f"{s}_mix"), f"fix_{s}_tech": F.col(f"{s}_tech"),
            f"fix_{s}_bill_code": F.concat(F.col(f"{s}_bb_nm"), F.lit("-"), F.col(f"{s}_num_rgus").cast("string")),
            f"fix_{s}_overdue": F.col(f"{s}_age"),
        }
    return fixed_table(inputs).select("period", *[c.alias(n) for n, c in columns.items()])


def phone_mobile(inputs: Inputs) -> DataFrame:
    """Mobile table in the layout of the phone-matched market."""
    churn = F.col("mobile_churn_type")
    columns = {
        "mob_churn_flag": F.when(churn.isNotNull(), CP.MOBILE_CHURNER).otherwise(CP.MOBILE_STAYER),
        "mob_churn_type": churn,
        "mob_movement": F.when((F.col("active_bom") == 0) & (F.col("e_mobile_tenure") == "Early Tenure"), CP.NEW)
        .when(F.col("active_bom") == 0, CP.BACK),
        "mob_rejoiner": P.flag(F.col("mobile_rejoiner_type").isNotNull()),
    }
    for s, when in (("b", "bom"), ("e", "eom")):
        columns |= {
            f"mob_{s}_active": F.col(f"active_{when}"), f"mob_{s}_tenure": F.replace(
                F.col(f"{s}_mobile_tenure"), F.lit(" "), F.lit("-")),
            f"mob_{s}_mrc": F.col(f"{s}_mrc"), f"mob_{s}_rgus": F.col(f"active_{when}"),
        }
    return mobile_table(inputs).select("period", "mobile_account", *[c.alias(n) for n, c in columns.items()])


def prepaid_phones(inputs: Inputs) -> DataFrame:
    """Prepaid numbers seen as open at the start and the end: low-priority orders."""
    rows = inputs.table("orders").where(F.col("o_orderpriority") == "5-LOW")
    return rows.select(
        F.concat(F.lit("7"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("phone"),
        P.flag(F.col("o_orderstatus") == "O").alias("on_b"),
        P.flag(F.col("o_orderstatus") == "F").alias("on_e"))


def phone_fmc_base(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Base of the phone-matched market.

    Matching and joining both read the two account-period tables: pass saved ones.
    """
    return CP.fmc_base(fixed, mobile, CP.phone_converge(fixed, mobile))


def phone_fmc_adjusted(fixed: DataFrame, mobile: DataFrame, prepaid: DataFrame) -> DataFrame:
    return CP.fmc_adjust(CP.fmc_class(phone_fmc_base(fixed, mobile), prepaid, REAL_CODES))


def phone_fmc_table(fixed: DataFrame, mobile: DataFrame, prepaid: DataFrame) -> DataFrame:
    """Converged table of the phone-matched market."""
    return CP.fmc_waterfall(phone_fmc_adjusted(fixed, mobile, prepaid))
