"""Fixed-mobile convergence: matching, segments and the monthly waterfall.

Rules are ordered chains, first match wins. Some later rules are shadowed by earlier
ones (size and charge comparisons come before packing and gross adds); the order is kept
on purpose.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abonara.functions import values as V
from abonara.functions.profile import flag, full_plan, last10
from abonara.functions.rules import first_match
from abonara.operators.dedup import attach_multiplicity

SOFT, NEAR, FIXED_ONLY, MOBILE_ONLY = "Soft FMC", "Near FMC", "Fixed Only", "Mobile Only"


def _is(name: str, value) -> Column:
    return F.coalesce(F.col(name) == value, F.lit(False))


def _on(name: str) -> Column:
    return _is(name, 1)


def _known(name: str) -> Column:
    return F.col(name).isNotNull()


def near_fmc(mobile: DataFrame, fixed_emails: DataFrame,
             blacklist: Iterable[str] = V.PLACEHOLDER_EMAILS,
             sides: Iterable[str] = ("b", "e")) -> DataFrame:
    """Find mobile accounts whose e-mail a fixed account also uses.

    Adds ``{side}_near_email``, ``{side}_near_account`` (the lowest fixed account) and
    ``{side}_near_accounts`` (how many share it). The fixed side is reduced to one row per
    address first, so an address that many accounts use on both sides adds no pairs.
    Mobile rows without a usable address get a key of their own that matches nothing;
    otherwise they would all meet in one join partition.
    """
    banned = [e.upper() for e in blacklist]
    usable = fixed_emails.where(_known("email") & ~F.upper("email").isin(*banned))
    by_email = usable.groupBy("email").agg(
        F.min("account").alias("_account"), F.count_distinct("account").alias("_accounts"))
    for side in sides:
        email = F.col(f"{side}_email")
        clean = F.when(~F.upper(email).isin(*banned), email)
        right = by_email.select(
            F.col("email").alias("_key"), F.col("email").alias(f"{side}_near_email"),
            F.col("_account").alias(f"{side}_near_account"),
            F.col("_accounts").alias(f"{side}_near_accounts"))
        own = F.concat(F.lit("none:"), F.col("mobile_account"))
        mobile = mobile.withColumn("_key", F.coalesce(clean, own)).join(right, "_key", "left").drop("_key")
    return mobile


def crowded_contracts(lines: DataFrame, share: int = 2000, contract: str = "fixed_contract") -> list[str]:
    """Keys that own more than one in ``share`` of all ``lines``: at most ``share`` of them.

    Run over the raw line table (one aggregate); the result is the ``crowded`` of :func:`converge`.
    """
    counts = lines.where(_known(contract)).groupBy(last10(F.col(contract)).alias("key")).agg(F.count("*").alias("n"))
    limit = lines.count() / share
    return [r.key for r in counts.where(F.col("n") > limit).select("key").collect()]


def _joined(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Convergence of hot keys: a left join, whose hot side Spark splits, and the accounts without a line."""
    lines = mobile.groupBy("_key", "period").agg(F.count("*").alias("copies"))
    counted = fixed.join(lines, ["_key", "period"], "left")
    with_line = mobile.join(counted.where(_known("copies")), ["_key", "period"], "left")
    return with_line.unionByName(counted.where(~_known("copies")), allowMissingColumns=True)


def _met(fixed: DataFrame, mobile: DataFrame) -> DataFrame:
    """Convergence of all other keys: a full join, each table shuffled once by key and period.

    A line takes every account of its key (one, unless ids share their last digits); an account
    without a line stands alone. Null keys and periods meet each other. The columns stay flat, so
    that a reader of a few labels does not move and sort all columns of both tables. The lines of
    one contract and period are held together.
    """
    keys = ["_text", "_day", "_nulls"]
    safe = {"_text": F.coalesce("_key", F.lit("")), "_day": F.coalesce("period", F.lit("1970-01-01").cast("date")),
            "_nulls": F.col("_key").isNull().cast("int") + 2 * F.col("period").isNull().cast("int")}
    fixed, mobile = (df.withColumns(safe).drop("_key", "period") for df in (fixed, mobile))
    lines = mobile.withColumn("copies", F.count("*").over(Window.partitionBy(*keys)))
    return (fixed.withColumn("_fixed", F.lit(True)).join(lines, keys, "full")
            .withColumns({"period": F.when(F.col("_nulls") < 2, F.col("_day")),
                          "copies": F.when(_known("_fixed"), F.coalesce("copies", F.lit(1)))})
            .drop("_fixed", *keys))


def converge(fixed: DataFrame, mobile: DataFrame, crowded: Sequence[str] = ()) -> DataFrame:
    """Full join of the fixed and the mobile table on the normalized account and period.

    ``fixed`` has one row per account and period, the account as ``fixed_account``;
    ``mobile`` brings ``fmc_account``, ``mobile_active_bom`` and ``mobile_active_eom``.
    ``copies`` tells on how many rows of the period a fixed account appears: as many as
    mobile lines share its key, at least one.

    Each table is computed and shuffled once. A contract that owns a large share of all lines would
    meet in one task, which holds its lines of a period in memory; name such keys in ``crowded``
    (see :func:`crowded_contracts`) and they are joined in a way that Spark can split.
    """
    fixed = fixed.withColumn("_key", last10(F.col("fixed_account")))
    mobile = mobile.withColumn("_key", last10(F.col("fmc_account")))
    if crowded:
        hot = F.col("_key").isin(*crowded)
        joined = _met(fixed.where(~hot), mobile.where(~hot)).unionByName(
            _joined(fixed.where(hot), mobile.where(hot)).drop("_key"))
    else:
        joined = _met(fixed, mobile)
    return joined.withColumns({
        "copies": F.coalesce("copies", F.lit(1)),
        "final_account": F.concat_ws("", "fixed_account", "mobile_account"),
        "final_bom_active": flag(_on("active_bom") | _on("mobile_active_bom")),
        "final_eom_active": flag(_on("active_eom") | _on("mobile_active_eom")),
    })


def fmc_status(df: DataFrame) -> DataFrame:
    """Add ``b_fmc_status`` and ``e_fmc_status``.

    At the end a lost mobile line is not mobile only. The source compares with a label
    that its mobile step never produces; any mobile churn type is meant.
    """
    def status(side: str, when: str, mobile_counts: Column) -> Column:
        fixed, mobile = _on(f"active_{when}"), _on(f"mobile_active_{when}")
        contract = _known(f"{side}_fixed_contract")
        return first_match([
            (fixed & mobile & contract, SOFT),
            ((_known(f"{side}_near_email") & ~contract & fixed) | (fixed & mobile), NEAR),
            (fixed & ~mobile, FIXED_ONLY),
            (mobile & ~fixed & mobile_counts, MOBILE_ONLY),
        ])
    return df.withColumns({
        "b_fmc_status": status("b", "bom", F.lit(True)),
        "e_fmc_status": status("e", "eom", ~_known("mobile_churn_type")),
    })


def fmc_type(df: DataFrame) -> DataFrame:
    """Add ``b_fmc_type``, ``e_fmc_type`` and the mobile RGUs of both sides."""
    def fixed_size(side: str, held: Column):
        return [(held & _is(f"{side}_mix", f"{n}P"), f"Fixed {n}P") for n in (1, 2, 3)]

    b, e = F.col("b_fmc_status"), F.col("e_fmc_status")
    b_mobile, e_mobile = _on("mobile_active_bom"), _on("mobile_active_eom")
    fixed_churn, mobile_churn = _known("churn_type"), _known("mobile_churn_type")
    e_fixed = _on("active_eom")
    opening = fixed_size("b", b.isin(FIXED_ONLY, SOFT, NEAR) & ~b_mobile) + [
        (b.isin(SOFT, NEAR) & ~_on("active_bom"), MOBILE_ONLY),
        (b.isin(MOBILE_ONLY, SOFT, NEAR), b),
        (_on("final_bom_active") & _is("b_num_rgus", 0), "Fixed 0P"),
    ]
    closing = [
        ((e == FIXED_ONLY) & fixed_churn, None),
        ((e == MOBILE_ONLY) & mobile_churn, None),
    ] + fixed_size("e", (e == FIXED_ONLY) & (~e_mobile | mobile_churn)) + [
        (e.isin(SOFT, NEAR, MOBILE_ONLY) & (~e_fixed | fixed_churn)
         | (e == MOBILE_ONLY) | (~e_fixed & e_mobile), MOBILE_ONLY),
        (e.isin(SOFT, NEAR) & ~fixed_churn & ~mobile_churn & e_fixed & e_mobile, e),
        (_on("final_eom_active") & _is("e_num_rgus", 0), "Fixed 0P"),
    ]
    return df.withColumns({
        "b_fmc_type": first_match(opening), "e_fmc_type": first_match(closing),
        "b_mobile_rgus": flag(b_mobile), "e_mobile_rgus": flag(e_mobile),
    })


def final_flags(df: DataFrame) -> DataFrame:
    """Add the technology and tenure flags that count the fixed line first."""
    def tech(side: str, when: str, stays: Column) -> Column:
        status = F.col(f"{side}_fmc_status")
        fixed, mobile = _on(f"active_{when}"), _on(f"mobile_active_{when}")
        converged = status.isin(SOFT, NEAR)
        return first_match([
            (((status == FIXED_ONLY) | (converged & fixed & mobile)) & stays, F.col(f"{side}_tech")),
            ((status == MOBILE_ONLY) | (converged & ~fixed), "Wireless"),
        ])
    fixed_stays, mobile_stays = ~_known("churn_type"), ~_known("mobile_churn_type")
    return df.withColumns({
        "b_final_tech": tech("b", "bom", F.lit(True)),
        "e_final_tech": tech("e", "eom", fixed_stays),
        "b_final_tenure": F.coalesce("b_tenure_segment", "b_mobile_tenure"),
        "e_final_tenure": F.coalesce(F.when(fixed_stays, F.col("e_tenure_segment")),
                                     F.when(mobile_stays, F.col("e_mobile_tenure"))),
    })


def fmc_segment(df: DataFrame) -> DataFrame:
    """Add ``b_fmc_segment`` and ``e_fmc_segment`` (P0 to P4, P1_Fixed, P1_Mobile, P0_Fixed)."""
    sizes = {"1P": "P2", "2P": "P3", "3P": "P4"}
    b, e = F.col("b_fmc_type"), F.col("e_fmc_type")
    b_fmc, e_fmc = b.isin(SOFT, NEAR), e.isin(SOFT, NEAR)
    b_fixed, b_mobile = _on("active_bom"), _on("mobile_active_bom")
    e_fixed, e_mobile = _on("active_eom"), _on("mobile_active_eom")
    fixed_stays, mobile_stays = ~_known("churn_type"), ~_known("mobile_churn_type")
    fixed_sizes = ["Fixed 1P", "Fixed 2P", "Fixed 3P"]
    opening = [(b_fmc & _is("b_mix", mix), p) for mix, p in sizes.items()] + [
        (b_fmc & _is("b_mix", "0P"), "P0"),
        (b.isin(*fixed_sizes) | (b_fmc & ~b_mobile & b_fixed), "P1_Fixed"),
        ((b == MOBILE_ONLY) | ((b == SOFT) & ~b_fixed & b_mobile), "P1_Mobile"),
        ((b == "Fixed 0P") | (b_fmc & ~b_mobile & b_fixed), "P0_Fixed"),
    ]
    both = e_fmc & e_fixed & e_mobile & fixed_stays & mobile_stays
    closing = [(both & _is("e_mix", mix), p) for mix, p in sizes.items()] + [
        ((e.isin(*fixed_sizes) | (e_fmc & ~e_mobile)) & e_fixed & fixed_stays, "P1_Fixed"),
        (((e == MOBILE_ONLY) | ((e == SOFT) & ~e_fixed)) & e_mobile & mobile_stays, "P1_Mobile"),
        ((e == "Fixed 0P") | (e_fmc & ~e_mobile & e_fixed), "P0_Fixed"),
        (e_fmc & _is("e_mix", "0P"), "P0"),
    ]
    return df.withColumns({"b_fmc_segment": first_match(opening), "e_fmc_segment": first_match(closing)})


def final_churn(df: DataFrame) -> DataFrame:
    """Add ``final_churn_flag``: full, fixed, mobile, previous or non churner."""
    fixed, mobile = _known("churn_type"), _known("mobile_churn_type")
    vanished = (~fixed & _on("active_bom") & _on("mobile_active_bom")
                & ~_on("active_eom") & ~_on("mobile_active_eom"))
    return df.withColumn("final_churn_flag", first_match([
        ((fixed & mobile) | (_is("b_fmc_status", FIXED_ONLY) & fixed)
         | (_is("b_fmc_status", MOBILE_ONLY) & mobile) | vanished, "Full Churner"),
        (fixed & ~mobile, "Fixed Churner"),
        (~fixed & mobile, "Mobile Churner"),
        ((fixed & ~_on("active_bom")) | (mobile & ~_on("mobile_active_bom")), "Previous churner"),
    ], "Non Churner"))


def totals(df: DataFrame) -> DataFrame:
    """Add total RGUs, charges, charge change and RGU churn.

    A fixed account that appears on several rows of a period shares its bill and RGUs
    among them (``copies``); the shares are fractions, nothing is truncated.
    """
    if "copies" not in df.columns:
        df = attach_multiplicity(df, ["period", "fixed_account"], "copies")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    mrc = lambda s: zero_money(f"{s}_bill_amt") / F.col("copies") + zero_money(f"{s}_mrc")
    zero_money = lambda c: F.coalesce(F.round(F.col(c), 0), F.lit(0.0))
    rgus = lambda s: (zero(f"{s}_num_rgus") + zero(f"{s}_mobile_rgus")) / F.col("copies")
    df = df.withColumns({f"{s}_total_mrc": mrc(s) for s in "be"} | {f"{s}_total_rgus": rgus(s) for s in "be"})
    return df.withColumns({
        "mrc_change": F.round("e_total_mrc", 0) - F.round("b_total_mrc", 0),
        "total_rgu_churn": zero("rgu_churn") / F.col("copies") + zero("mobile_rgu_churn"),
    })


def final_rejoiner(df: DataFrame) -> DataFrame:
    """Add ``rejoiner_flag``; either line back on a converged account is an FMC rejoiner."""
    fixed, mobile = _known("rejoiner_type"), _known("mobile_rejoiner_type")
    converged = F.coalesce(F.col("e_fmc_type").isin(SOFT, NEAR), F.lit(False))
    return df.withColumn("rejoiner_flag", first_match([
        ((fixed & mobile) | ((fixed | mobile) & converged), "FMC Rejoiner"),
        (fixed, "Fixed Rejoiner"),
        (mobile, "Mobile Rejoiner"),
    ]))


def partial_total(df: DataFrame) -> DataFrame:
    """Add ``partial_total_churn`` and ``final_churn_type``."""
    churn = F.col("final_churn_flag")
    return df.withColumns({
        "partial_total_churn": first_match([
            (churn == "Full Churner", "Total Churner"),
            (churn.isin("Fixed Churner", "Mobile Churner"), "Partial Churner"),
            (churn == "Previous churner", churn),
        ]),
        "final_churn_type": first_match([
            (_is("churn_type", V.FIXED_VOLUNTARY), "Voluntary"),
            (_is("mobile_churn_type", V.MOBILE_VOLUNTARY_CHURN), "Voluntary"),
            (_is("churn_type", V.FIXED_INVOLUNTARY), "Involuntary"),
            (_is("mobile_churn_type", V.MOBILE_INVOLUNTARY_CHURN), "Involuntary"),
            (_is("main_movement", V.DOWNSELL), "Voluntary"),
        ]),
    })


def waterfall(df: DataFrame) -> DataFrame:
    """Add ``waterfall`` and the full plans of both sides.

    A mobile gross add is a line active only at the end; the source tests movement labels
    that its mobile step no longer writes.
    """
    b_rgus, e_rgus = F.col("b_total_rgus"), F.col("e_total_rgus")
    b_mrc, e_mrc = F.col("b_total_mrc"), F.col("e_total_mrc")
    same = b_rgus == e_rgus
    converged = F.coalesce(F.col("e_fmc_type").isin(SOFT, NEAR), F.lit(False))
    single = F.col("b_fmc_type").isin("Fixed 0P", "Fixed 1P", "Fixed 2P", "Fixed 3P", MOBILE_ONLY)
    fixed_add = F.coalesce(F.col("main_movement").isin(V.COME_BACK, V.NEW), F.lit(False))
    mobile_add = ~_on("mobile_active_bom") & _on("mobile_active_eom")
    fixed_back, mobile_back = _known("rejoiner_type"), _known("mobile_rejoiner_type")
    return df.withColumns({
        "waterfall": first_match([
            (F.col("final_churn_flag") != "Non Churner", F.col("final_churn_flag")),
            (same & (b_mrc == e_mrc), "Maintain"),
            (b_rgus < e_rgus, "Upsell"),
            (b_rgus > e_rgus, "Downsell"),
            (same & (b_mrc < e_mrc), "Upspin"),
            (same & (b_mrc > e_mrc), "Downspin"),
            (single & converged, "FMC Packing"),
            (_is("final_bom_active", 0) & converged, "FMC Gross Add"),
            (fixed_back & mobile_back, "FMC Rejoiner"),
            (fixed_back, "Fixed Rejoiner"),
            (mobile_back, "Mobile Rejoiner"),
            (fixed_add & mobile_add, "FMC Gross Add"),
            (fixed_add, "Fixed Gross Add"),
            (mobile_add, "Mobile Gross Add"),
        ]),
        "b_plan_full": full_plan(F.col("b_plan"), F.col("mobile_active_bom")),
        "e_plan_full": full_plan(F.col("e_plan"), F.col("mobile_active_eom")),
    })


def splits(df: DataFrame) -> DataFrame:
    """Add ``downsell_split`` and ``downspin_split``."""
    down = F.col("waterfall") == "Downsell"
    return df.withColumns({
        "downsell_split": first_match([
            (down & _is("main_movement", V.DOWNSELL), "Voluntary"),
            (down & (F.col("final_churn_flag") != "Non Churner"), F.col("final_churn_type")),
            (down & _is("main_movement", V.LOSS), "Undefined"),
        ]),
        "downspin_split": F.when(F.col("waterfall") == "Downspin", "Voluntary"),
    })
