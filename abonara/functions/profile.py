"""Row-level derivations on the account snapshot: products, tenure, ages, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abonara.functions import values as V
from abonara.functions.rules import any_of, first_match, like_any

LINES = ("vo", "tv", "bb")


def present(name: Column) -> Column:
    """A product name counts when it is neither null nor empty."""
    return name.isNotNull() & (name != "")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def rgu_flags(df: DataFrame) -> DataFrame:
    """Add ``rgu_vo``, ``rgu_tv``, ``rgu_bb`` (0/1) from the product names."""
    return df.withColumns({f"rgu_{line}": flag(present(F.col(f"{line}_nm"))) for line in LINES})


def rgu_flags_from_arrays(df: DataFrame) -> DataFrame:
    """The same flags when each product column is an array of names."""
    return df.withColumns({
        f"rgu_{line}": flag(F.coalesce(F.size(F.col(f"{line}_nms")), F.lit(0)) > 0)
        for line in LINES
    })


def rgu_count() -> Column:
    return F.col("rgu_vo") + F.col("rgu_tv") + F.col("rgu_bb")


def product_mix() -> Column:
    """``0P`` to ``3P`` from the RGU flags.

    Three empty names are ``0P`` here; the scripts this follows let them slip to ``1P``.
    """
    return F.concat(rgu_count().cast("string"), F.lit("P"))


def mix_from_quantities(vo: Column, tv: Column, bb: Column) -> Column:
    """``1P`` to ``3P`` from quantities; nulls count as zero, other totals give null."""
    total = F.coalesce(vo, F.lit(0)) + F.coalesce(tv, F.lit(0)) + F.coalesce(bb, F.lit(0))
    return F.when(total.between(1, 3), F.concat(total.cast("string"), F.lit("P")))


def quantity_from_mix(mix: Column) -> Column:
    """``1P`` → 1, ``2P`` → 2, ``3P`` → 3, anything else 0."""
    return F.when(mix.isin("1P", "2P", "3P"), F.substring(mix, 1, 1).cast("int")).otherwise(0)


def bundle_name() -> Column:
    """Names of the lines held, joined by ``+`` in the order BB, TV, VO; null for none."""
    parts = [F.when(F.col(f"rgu_{line}") == 1, line.upper()) for line in ("bb", "tv", "vo")]
    return F.nullif(F.concat_ws("+", *parts), F.lit(""))


def tech_flag(fiber: str = "FTTH", premium_tv: str = "NextGen TV", other: str = "HFC") -> Column:
    """Fiber when a broadband or voice name says so, or for the premium TV without broadband."""
    bb, tv, vo = F.col("bb_nm"), F.col("tv_nm"), F.col("vo_nm")
    is_fiber = any_of([
        bb.contains(fiber),
        (tv == premium_tv) & bb.isNull(),
        vo.contains(fiber),
    ])
    return F.when(is_fiber, "FTTH").otherwise(other)


def tech_flag_from_arrays(
    fiber: str = "FTTH", premium_tv: str = "NextGen TV", other: str = "HFC"
) -> Column:
    """The array variant: any name in the list may carry the fiber mark."""
    bb, tv, vo = F.col("bb_nms"), F.col("tv_nms"), F.col("vo_nms")
    is_fiber = any_of([
        F.exists(bb, lambda name: name.contains(fiber)),
        F.array_contains(tv, premium_tv) & (F.size(bb) == 0),
        F.exists(vo, lambda name: name.contains(fiber)),
    ])
    return F.when(is_fiber, "FTTH").otherwise(other)


def access_technology(bb: Column, tv: Column, vo: Column) -> Column:
    """Access medium of the best line that has one; unknown media mean copper.

    Broadband decides even when its medium is unknown only if it is null do TV and then
    voice get a say.
    """
    known = lambda medium: F.when(medium.isin("FTTH", "HFC"), medium)
    return F.coalesce(
        known(bb),
        F.when(bb.isNull(), known(tv)),
        F.when(bb.isNull() & tv.isNull(), known(vo)),
        F.lit("COPPER"),
    )


def province_name(code: Column, names: dict[str, str] | None = None) -> Column:
    """Look a province code up in a small literal map; unknown codes give null."""
    pairs = [F.lit(x) for item in (names or V.PROVINCES).items() for x in item]
    return F.create_map(*pairs)[code]


def plan_fingerprint(prefix: str = "") -> Column:
    """The three product names glued together, a dash for each missing one."""
    return F.concat(*[F.coalesce(F.col(f"{prefix}{line}_nm"), F.lit("-")) for line in LINES])


def full_plan(plan: Column, mobile_active: Column) -> Column:
    """Fixed plan followed by the mobile-active flag (a dash when unknown)."""
    return F.concat(
        F.coalesce(plan, F.lit("")), F.coalesce(mobile_active.cast("string"), F.lit("-"))
    )


def unchanged_plan_account(before: Column, after: Column, account: Column) -> Column:
    """The account id when the plan did not change, else null."""
    return F.when(before == after, account)


def tenure_segment(months: Column, early: int = 6, mid: int = 12) -> Column:
    """Early up to ``early`` months, Mid up to ``mid``, Late above; both cuts inclusive."""
    return first_match([
        (months <= early, "Early Tenure"),
        (months <= mid, "Mid Tenure"),
        (months > mid, "Late Tenure"),
    ])


def tenure_segment_from_days(days: Column, early: int = 6, mid: int = 12) -> Column:
    """The same on whole 30-day months."""
    return tenure_segment(F.floor(days / 30), early, mid)


def mobile_tenure_segment(months: Column, cut: int = 6) -> Column:
    """Early below ``cut`` months, Late from it on."""
    return first_match([(months < cut, "Early Tenure"), (months >= cut, "Late Tenure")])


def mrc_total(vo: Column, bb: Column, tv: Column) -> Column:
    """Rounded sum of the three charges; null when any is null."""
    return F.round(vo + bb + tv, 0)


def last10(key: Column, width: int = 10) -> Column:
    """Last ten characters of an account id, left padded with zeros."""
    text = key.cast("string")
    return F.lpad(F.right(text, F.lit(width)), width, "0")


def oldest_unpaid(day: Column, age: Column) -> Column:
    """Date of the oldest unpaid bill; 1900-01-01 stands for nothing unpaid."""
    return F.when(age.isNull(), F.to_date(F.lit("1900-01-01"))).otherwise(F.date_sub(day, age))


def overdue_age(age: Column, bills: list[tuple[Column, Column]]) -> Column:
    """Age minus the grace days of the newest known bill.

    ``bills`` are (bill date, due date) pairs, newest first. The first pair with a bill
    date decides, the last pair decides when none has one.
    """
    chain = F
    for bill, due in bills[:-1]:
        chain = chain.when(bill.isNotNull(), age - F.datediff(due, bill))
    bill, due = bills[-1]
    last = age - F.datediff(due, bill)
    return last if chain is F else chain.otherwise(last)


def bridged_age(day: Column, overdue: Column, outstanding: Column, cutover: str, add: int = 20):
    """Before ``cutover`` the overdue age plus ``add`` days, then the outstanding age."""
    return F.when(day < F.to_date(F.lit(cutover)), overdue + add).otherwise(outstanding)


def activity_tag(age: Column, days: int = 90) -> Column:
    return first_match([(age >= days, "Inactive"), (age < days, "Active")])


def movement_reason(code: Column, kind: Column, description: Column) -> Column:
    """Churn type of a movement-log entry."""
    left = (code == V.LOG_LEAVE) & (kind == V.LOG_OUT)
    return first_match([
        (left & description.isin(*V.VOLUNTARY_DESCRIPTIONS), V.FIXED_VOLUNTARY),
        (left & description.isin(*V.INVOLUNTARY_DESCRIPTIONS), V.FIXED_INVOLUNTARY),
    ])


def mobile_movement_reason(
    movement: Column, leave_kind: Column, migration_kind: Column,
    port_out_involuntary: bool = False,
) -> Column:
    """Churn type of a mobile movement.

    A leave counts with either kind column; the movement must be a leave for both, which
    is the rule the source text intends.
    """
    is_kind = lambda kind: (movement == V.MOBILE_LEAVE) & any_of([
        F.coalesce(leave_kind == kind, F.lit(False)),
        F.coalesce(migration_kind == kind, F.lit(False)),
    ])
    port_out = V.MOBILE_INVOLUNTARY_CHURN if port_out_involuntary else V.MOBILE_VOLUNTARY_CHURN
    return first_match([
        (movement == V.MOBILE_OUT_MIGRATION, V.MOBILE_INVOLUNTARY_CHURN),
        (is_kind(V.MOBILE_INVOLUNTARY), V.MOBILE_INVOLUNTARY_CHURN),
        (is_kind(V.MOBILE_PORT_OUT), port_out),
        (is_kind(V.MOBILE_VOLUNTARY), V.MOBILE_VOLUNTARY_CHURN),
    ])


def channel_group(channel: Column) -> Column:
    """Sales-channel group by exact name or fragment, first group wins."""
    rules = []
    for label, names, fragments in V.CHANNEL_GROUPS:
        tests = [channel.isin(*names)] + [channel.contains(f) for f in fragments]
        rules.append((any_of(tests), label))
    return first_match(rules)


def collapse_channel(channel: Column, fragments: tuple[str, ...] = ("D2D", "Digital")) -> Column:
    """Fold every channel that holds one of the fragments into that fragment."""
    return first_match([(channel.contains(f), f) for f in fragments], channel)


def classify_claim(purpose: Column, text: Column) -> Column:
    """Claim category of a lower-cased disposition text, first pattern list wins.

    ``text`` is used by every pattern: pass a column that an earlier projection lowered,
    else each pattern lowers the text again.
    """
    claim = purpose == "CLAIM"
    rules = [(claim & like_any(text, patterns), label) for label, patterns in V.CLAIM_PATTERNS]
    return first_match(rules + [
        (claim, "other_claims"),
        (purpose == "TICKET", "tech_ticket"),
        (purpose == "TRUCKROLL", "tech_truckroll"),
    ])


def claim_type(category: Column) -> Column:
    """Five coarse types of the claim categories."""
    pairs = [F.lit(x) for item in V.CLAIM_TYPES.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[category], F.lit("Others"))


def disposition_text(purpose: Column, claim_parts: list[Column], tech_parts: list[Column]) -> Column:
    """Text that the claim patterns look at: two info fields joined by a dash."""
    join = lambda parts: F.replace(
        F.concat_ws("-", *[F.lower(F.coalesce(p, F.lit(" "))) for p in parts]),
        F.lit("  "), F.lit(""))
    return (F.when(purpose == "CLAIM", join(claim_parts))
            .when(purpose.isin("TICKET", "TRUCKROLL"), join(tech_parts)))


def classify_technical(
    text: Column, include: tuple[str, ...] = V.TECH_CALL_INCLUDE,
    exclude: tuple[str, ...] = V.TECH_CALL_EXCLUDE,
) -> Column:
    """``tech_call`` when an include pattern and no exclude pattern matches.

    ``text`` is lower-cased beforehand, as for :func:`classify_claim`.
    """
    return F.when(like_any(text, include) & ~like_any(text, exclude), "tech_call")
