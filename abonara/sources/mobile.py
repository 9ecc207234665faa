"""Cleaning of the dirty-text mobile subscriber extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abonara.functions import values as V


def clean_mobile(
    raw: DataFrame,
    day_first_extracts: tuple[str, ...] = ("30/11/2022",),
    exclude_plans: bool = True,
) -> DataFrame:
    """Typed mobile base, one row per distinct cleaned extract row.

    - the extract day comes as ``dd/MM/yyyy`` or ``yyyy-MM-dd``; a base extracted in one
      month opens the next, so ``month`` is the month after the extract
    - subscriber ids lose their dots and commas
    - missing contract marks become null; broken rents become null, a missing rent is 0
    - activation dates are month-first except in ``day_first_extracts``; device names in
      that column become null
    - business segments always go, test plans and uses unless ``exclude_plans`` is off;
      a null in those columns drops the row, as ``<>`` and ``NOT IN`` do
    """
    extract = F.col("extract_day").cast("string")
    extract_date = F.when(
        extract.contains("/"), F.try_to_date(F.substring(extract, 1, 10), "dd/MM/yyyy")
    ).otherwise(F.try_to_date(F.substring(extract, 1, 10), "yyyy-MM-dd"))

    contract, rent, activated = F.col("contract"), F.col("rent"), F.col("activation_day")
    ten = F.substring(activated, 1, 10)
    activation = F.when(
        extract.isin(*day_first_extracts), F.try_to_date(ten, "dd/MM/yyyy")
    ).otherwise(F.try_to_date(ten, "MM/dd/yyyy"))
    broken_rent = rent.contains("#") | rent.contains("/") | (rent == "NULL")

    kept = raw.where(~F.col("segment").isin(*V.BUSINESS_SEGMENTS))
    if exclude_plans:
        kept = kept.where(
            ~F.col("plan_id").isin(*V.EXCLUDED_MOBILE_PLANS)
            & ~F.col("use").isin(*V.EXCLUDED_MOBILE_USES)
        )
    return kept.select(
        F.add_months(F.trunc(extract_date, "month"), 1).alias("month"),
        F.translate(F.col("subscriber_id"), ".,", "").alias("mobile_account"),
        F.when(~contract.isin(*V.MISSING_CONTRACT), contract).alias("fixed_contract"),
        F.col("phone"),
        F.col("email"),
        F.col("segment"),
        F.when(broken_rent, None)
        .otherwise(F.expr("try_cast(replace(coalesce(rent, '0'), ',', '.') AS double)"))
        .alias("mrc"),
        F.when(~activated.isin(*V.NOT_A_DATE), activation).alias("start_dt"),
    ).distinct()
