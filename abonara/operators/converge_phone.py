"""Convergence in the market that matches accounts by phone, and by household."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions.calendar import period_of
from abonara.functions.profile import flag
from abonara.functions.rules import first_match
from abonara.operators.dedup import rank_pairs

# Labels of this market's fixed and mobile tables.
FIXED_CHURNER, FIXED_STAYER = "1. Fixed Churner", "2. Fixed NonChurner"
MOBILE_CHURNER, MOBILE_STAYER = "1. Mobile Churner", "2. Mobile NonChurner"
VOL, INVOL = "1. Fixed Voluntary Churner", "2. Fixed Involuntary Churner"
TRANSFER, ZERO_P = "3. Fixed Transfer", "3. Fixed 0P Churner"
MOB_VOL, MOB_INVOL = "1. Mobile Voluntary Churner", "2. Mobile Involuntary Churner"
NEW, BACK, NULL_LAST_DAY, TRANSFER_ADD, GAP = (
    "4.New Customer", "5.Come Back to Life", "6.Null last day", "7.Transfer Adds",
    "8.Rejoiner-GrossAdd Gap")
TENURES = ("Early-Tenure", "Mid-Tenure", "Late-Tenure")


def phone_converge(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Match either phone of a fixed account to a mobile number of the same period.

    The phones are exploded to one column and joined once. A number is one mobile
    account, so a pair exists at most once per phone. Kept are each fixed account's best
    pair and each number's best two; ``match_rank`` numbers what is left per number.

    Both tables have one row per account and period. Saved ones compress so well that the size of
    a few columns in the files is a hundredth of their size in memory; the joins are merged, or
    Spark would take the numbers for a small table and broadcast them.
    """
    phones = (fixed.select("period", "fixed_account", F.explode(F.array_distinct(F.array_compact(
        F.array("phone1", "phone2")))).alias("mobile_account")))
    numbers = mobile.select("period", "mobile_account").hint("merge")
    pairs = phones.join(numbers, ["period", "mobile_account"], "left_semi")
    kept = rank_pairs(pairs)
    left_over = Window.partitionBy("period", "mobile_account").orderBy(F.desc("fixed_account"))
    return kept.withColumn("match_rank", F.row_number().over(left_over)).drop("left_rank", "right_rank")


def _merge_tenure(fixed: Column, mobile: Column) -> Column:
    """Earliest of the two segments; the known one when only one is known."""
    either = lambda label: F.coalesce(fixed == label, F.lit(False)) | F.coalesce(mobile == label, F.lit(False))
    return F.when(fixed.isNull() | mobile.isNull() | (fixed == mobile), F.coalesce(fixed, mobile)).otherwise(
        first_match([(either(TENURES[0]), TENURES[0]), (either(TENURES[1]), TENURES[1])]))


def fmc_base(fixed: DataFrame, mobile: DataFrame, matches: DataFrame) -> DataFrame:
    """Full join of both tables over the phone matches, with combined columns.

    Fixed columns start with ``fix_``, mobile columns with ``mob_``. Accounts without a
    match get a key of their own, so that they do not gather in one null partition.
    """
    matched = fixed.join(
        matches.withColumnRenamed("mobile_account", "_mobile").hint("merge"), ["period", "fixed_account"], "left")
    left = matched.withColumn("_key", F.coalesce("_mobile", F.concat(F.lit("none:"), "fixed_account")))
    right = mobile.withColumn("_key", F.col("mobile_account"))
    joined = left.join(right, ["period", "_key"], "full").drop("_key", "_mobile")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    columns = {
        "fmc_account": F.concat_ws(" - ", "fixed_account", "mobile_account"),
        "mobile_copy": F.when(F.col("mobile_account").isNotNull(), F.coalesce("match_rank", F.lit(1))).otherwise(1),
    }
    for s in "be":
        columns |= {
            f"fmc_{s}_active": flag(zero(f"fix_{s}_active") + zero(f"mob_{s}_active") >= 1),
            f"fmc_{s}_tenure": _merge_tenure(F.col(f"fix_{s}_tenure"), F.col(f"mob_{s}_tenure")),
            f"fmc_{s}_rgus": zero(f"fix_{s}_rgus") + zero(f"mob_{s}_rgus"),
            f"fmc_{s}_mrc": F.coalesce(F.col(f"fix_{s}_mrc"), F.lit(0.0))
            + F.coalesce(F.col(f"mob_{s}_mrc"), F.lit(0.0)),
        }
    return joined.withColumns(columns).drop("match_rank")


def fmc_class(df: DataFrame, prepaid: DataFrame, real_codes: Iterable[str]) -> DataFrame:
    """Add ``fmc_{b,e}_class`` from activity, the prepaid list and the bill codes.

    ``prepaid`` has a phone and 0/1 columns ``on_b`` and ``on_e``; one row per phone.
    ``real_codes`` is the short list of bill codes that make an offer real.
    """
    phones = prepaid.groupBy("phone").agg(F.max("on_b").alias("on_b"), F.max("on_e").alias("on_e"))
    for n in (1, 2):
        listed = phones.select(F.col("phone").alias(f"_p{n}"), F.col("on_b").alias(f"_b{n}"),
                               F.col("on_e").alias(f"_e{n}"))
        own = F.concat(F.lit("none:"), F.coalesce("fixed_account", "mobile_account"))
        df = df.withColumn(f"_p{n}", F.coalesce(f"phone{n}", own)).join(listed.hint("merge"), f"_p{n}", "left").drop(f"_p{n}")
    codes = list(real_codes)
    for s in "be":
        fixed = F.coalesce(F.col(f"fix_{s}_active"), F.lit(0)) == 1
        mobile = F.coalesce(F.col(f"mob_{s}_active"), F.lit(0)) == 1
        listed = F.coalesce(F.greatest(f"_{s}1", f"_{s}2"), F.lit(0)) == 1
        real = F.coalesce(F.col(f"fix_{s}_bill_code").isin(*codes), F.lit(False))
        kind = F.when(real, "Real FMC").otherwise("Near FMC")
        df = df.withColumn(f"fmc_{s}_class", first_match([
            (fixed & ~mobile & listed, F.concat(F.lit("Prepaid "), kind)),
            (fixed & ~mobile, "Fixed Only"),
            (~fixed & mobile, "Mobile Only"),
            (fixed & mobile & listed, kind),
            (fixed & mobile, F.concat(F.lit("Postpaid "), kind)),
        ]))
    return df.drop("_b1", "_e1", "_b2", "_e2")


def _equals(name: str, value) -> Column:
    return F.coalesce(F.col(name) == value, F.lit(False))


def fmc_adjust(df: DataFrame) -> DataFrame:
    """Add segment, technology, rejoiner, churn flag and churn type."""
    columns = {}
    for s in "be":
        kind, mix = F.col(f"fmc_{s}_class"), F.col(f"fix_{s}_mix")
        larger = F.concat((F.substring(mix, 1, 1).cast("int") + 1).cast("string"), F.lit("P "), kind)
        columns[f"fmc_{s}_segment"] = first_match([
            (kind == "Fixed Only", F.concat(mix, F.lit(" Fixed"))),
            (kind == "Mobile Only", "P1 Mobile"),
        ], larger)
        columns[f"fmc_{s}_tech"] = F.when(kind == "Mobile Only", "WIRELESS").otherwise(F.col(f"fix_{s}_tech"))
    fixed_back, mobile_back = _equals("fix_rejoiner", 1), _equals("mob_rejoiner", 1)
    columns["fmc_rejoiner"] = first_match([
        (fixed_back & mobile_back, "1. Full Rejoiner"),
        (fixed_back, "2. Fixed Rejoiner"),
        (mobile_back, "3. Mobile Rejoiner"),
    ])
    fixed_type, mobile_type = F.col("fix_churn_type"), F.col("mob_churn_type")
    left = _equals("fix_churn_flag", FIXED_CHURNER)
    moved = left & _equals("fix_churn_type", TRANSFER)
    gone = left & fixed_type.isNotNull() & (fixed_type != TRANSFER)
    mobile_left = _equals("mob_churn_flag", MOBILE_CHURNER)
    columns["fmc_churn_flag"] = first_match([
        (gone & mobile_left, "Churner"),
        (gone, "Fixed Churner"),
        ((moved | ~left) & mobile_left, "Mobile Churner"),
    ], "Non Churner")

    def one_kind(fixed_kind: str, mobile_kind: str) -> Column:
        on_fixed = (fixed_type == fixed_kind) & (mobile_type.isNull() | (mobile_type == mobile_kind))
        on_mobile = (mobile_type == mobile_kind) & (fixed_type.isNull() | (fixed_type == TRANSFER))
        return F.coalesce(on_fixed, F.lit(False)) | F.coalesce(on_mobile, F.lit(False))

    crossed = ((fixed_type == VOL) & (mobile_type == MOB_INVOL)) | ((fixed_type == INVOL) & (mobile_type == MOB_VOL))
    columns["fmc_churn_type"] = first_match([
        (one_kind(VOL, MOB_VOL), "Voluntary Churner"),
        (one_kind(INVOL, MOB_INVOL), "Involuntary Churner"),
        (crossed, "Mixed Churner"),
        ((fixed_type == ZERO_P) & mobile_type.isNull(), "0P Churner"),
        ((fixed_type == TRANSFER) & mobile_type.isNull(), "Fixed Transfer"),
    ], "Non Churner")
    return df.withColumns(columns)


def fmc_waterfall(df: DataFrame) -> DataFrame:
    """Add the rejoiner, partial or total churn and waterfall labels; keep live rows once.

    The source names converged segments by labels its segment step does not write
    (``2P FMC``); any two-to-four-play converged segment is meant.
    """
    segment = F.col("fmc_e_segment")
    converged = F.coalesce(segment.rlike("^[234]P .*FMC$"), F.lit(False))
    churn, kind = F.col("fmc_churn_flag"), F.col("fmc_churn_type")
    back = F.col("fmc_rejoiner")
    fixed_move, mobile_move = F.col("fix_movement"), F.col("mob_movement")
    starts = (F.col("fmc_b_active") == 0) & (F.col("fmc_e_active") == 1)
    stays = (F.col("fmc_b_active") == 1) & (F.col("fmc_e_active") == 1)
    leaves = (F.col("fmc_b_active") == 1) & (F.col("fmc_e_active") == 0)
    returns = _equals("fix_movement", BACK) | _equals("mob_movement", BACK)
    is_new = lambda move, *labels: F.coalesce(move.isin(*labels), F.lit(False))
    gross = ((is_new(fixed_move, NEW, GAP) & (mobile_move.isNull() | is_new(mobile_move, NEW)))
             | (fixed_move.isNull() & is_new(mobile_move, NEW)))
    b_rgus, e_rgus = F.col("fmc_b_rgus"), F.col("fmc_e_rgus")
    b_mrc, e_mrc = F.col("fmc_b_mrc"), F.col("fmc_e_mrc")
    same = stays & (b_rgus == e_rgus)
    fixed_starts = _equals("fix_b_active", 0) & _equals("fix_e_active", 1)
    lost = leaves & (churn != "Non Churner")
    no_transfer = kind != "Fixed Transfer"
    out = df.withColumns({
        "fmc_rejoiner_final": F.when(
            back.isin("2. Fixed Rejoiner", "3. Mobile Rejoiner") & converged, "1. FMC Rejoiner").otherwise(back),
        "partial_total_churn": first_match([
            ((churn == "Churner")
             | ((churn == "Fixed Churner") & segment.isNull() & no_transfer)
             | ((churn == "Mobile Churner") & _equals("fmc_b_segment", "P1 Mobile") & segment.isNull()
                & no_transfer), "Total Churner"),
            (churn == "Non Churner", None),
        ], "Partial Churner"),
        "waterfall": first_match([
            (starts & gross, "Gross Adds"),
            (fixed_starts & fixed_move.isNull() & F.col("fix_e_start").isNull(), "GrossAdds-Fixed Customer Gap"),
            (starts & returns & (churn != "Non Churner"), "ComeBackToLife-Fixed Customer Gap"),
            (starts & (back == "1. Full Rejoiner") & converged, "5.1. FMC Rejoiner"),
            (starts & (back == "2. Fixed Rejoiner") & ~converged & segment.isNotNull(), "5.2. Fixed Rejoiner"),
            (starts & (back == "3. Mobile Rejoiner") & ~converged & segment.isNotNull(), "5.3. Mobile Rejoiner"),
            (stays & back.isNotNull(), "5.4 Near Rejoiner"),
            (starts & returns & back.isNull(), "Gross Adds"),
            (starts & (kind == "Non Churner") & _equals("fix_movement", TRANSFER_ADD), "Fixed Transfer Adds"),
            (kind == "Fixed Transfer", "Fixed Transfer Churn"),
            (stays & (b_rgus < e_rgus), "Upsell"),
            (stays & (b_rgus > e_rgus), "Downsell"),
            (same & (b_mrc == e_mrc), "Maintain"),
            (same & (b_mrc < e_mrc), "Upspin"),
            (same & (b_mrc > e_mrc), "Downspin"),
            (lost & (kind == "Voluntary Churner"), "Voluntary Churner"),
            (lost & (kind == "Involuntary Churner"), "Involuntary Churner"),
            (lost & (kind == "Mixed Churner"), "Mixed Churner"),
            (leaves & _equals("fix_movement", NULL_LAST_DAY) & (churn == "Non Churner"),
             "Loss-Fixed Customer Gap"),
        ]),
    })
    return out.where((F.col("fmc_b_active") + F.col("fmc_e_active") >= 1) & (F.col("mobile_copy") == 1))


def household_fmc(snap: DataFrame, left: DataFrame, households: DataFrame,
                  hard_pairs: Iterable[tuple[str, str]], grain: str = "month", days: int = 90) -> DataFrame:
    """Convergence class of the live base by household type and product-code pairs.

    ``snap`` has one closing row per account and period with mix, age, first day and the
    voice and broadband codes. ``left`` are (account, period) with a completed voluntary
    disconnect, ``households`` (account, period, kind). Accounts with more than ``days``
    stay only in the period they first appear.
    """
    age = F.col("age")
    fresh = period_of(F.col("start_dt"), grain) == F.col("period")
    live = snap.where((F.col("mix") != "0P") & (age.isNull() | (age <= days) | (fresh & (age >= days))))
    base = live.join(left.where(F.col("account").isNotNull()), ["account", "period"], "left_anti")
    kind = F.col("kind")
    hard = [(F.col("vo_code") == vo) & (F.col("bb_code") == bb) for vo, bb in hard_pairs]
    classed = base.join(households, ["account", "period"], "left").withColumn("household_class", first_match(
        [(kind.isin("1. Inscrito a Paquete completo", "2. Beneficio manual"), "1.Soft FMC"),
         (kind.isin("2. Match_ID", "3. Contact number"), "2.Near FMC")]
        + [(pair, "3. Hard FMC") for pair in hard], "4.Fixed Only"))
    klass = F.col("household_class")
    return classed.withColumn("fmc_kind", first_match([
        (klass == "2.Near FMC", "Near FMC"),
        (klass.isin("1.Soft FMC", "3. Hard FMC"), "Real FMC"),
        (klass == "4.Fixed Only", F.concat(F.lit("Fixed Only "), F.col("mix"))),
    ]))
