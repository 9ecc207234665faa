"""Business inputs derived from the supplied star-schema and event tables.

The engine needs account snapshots, orders, contacts, payments and mobile extracts; the
supplied tables are orders, line items, customers and events. Each method below is a lazy
DataFrame over whole tables. ``catalog`` holds the same derivations as SQL.

Two families that do not meet in time: the order family (quarters 1995-2001) and the event
family (weeks and days of January 2024).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abonara.functions import values as V
from abonara.functions.calendar import period_of
from abonara.functions.profile import bundle_name, flag, mrc_total, oldest_unpaid, product_mix, rgu_count, rgu_flags, tech_flag
from abonara.functions.rules import first_match
from abonara.operators.dedup import keep_one, repair_age
from abonara.operators.snapshot import account_closing
from abonara.sources.tables import read_table

#: Which part types stand for which product line.
LINE_TYPES = {"vo": ("STANDARD", "SMALL"), "tv": ("ECONOMY", "MEDIUM"), "bb": ("PROMO", "LARGE")}

SALE_CHANNELS = ("PROM norte", "Dinamo", "Metro Mall", "Gestión 2", "Centro de Llamadas",
                 "Telefono", "AGENCIA sur", "Feria", "Kiosko")
ORDER_COMMANDS = ("MOROSIDAD", "TRAMITE INTERNO", "MIGRACION HFC", "CAMBIO NOMBRE", "OTRO")
LOG_DESCRIPTIONS = V.VOLUNTARY_DESCRIPTIONS + V.INVOLUNTARY_DESCRIPTIONS + ("Otra",)


def pick(options: tuple[str, ...], number: Column) -> Column:
    """Spread rows over text options by a number."""
    return F.element_at(
        F.array(*[F.lit(o) for o in options]), (F.pmod(number, F.lit(len(options))) + 1).cast("int"))


class Inputs:
    """Lazy business inputs of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    # -- order family ------------------------------------------------------------------

    @cached_property
    def order_lines(self) -> DataFrame:
        """Per order: product names, the largest charge per line, largest quantity.

        The first name of a line is found as a number and turned into text afterwards:
        fixed-width buffers keep the largest aggregate of the engine a hash aggregate,
        text buffers would make it sort every line item.
        """
        parts = self.table("part").select("p_partkey", "p_type")
        lines = self.table("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
        aggregates = [
            F.max(F.col("l_quantity") * 2).cast("int").alias("double_quantity"),
            F.max("l_linenumber").alias("lines"),
        ]
        names = []
        for line, types in LINE_TYPES.items():
            ordered = sorted(types)
            rank = first_match([(F.col("p_type") == t, n) for n, t in enumerate(ordered)])
            aggregates += [
                F.min(rank).alias(f"_{line}"),
                F.max(F.when(F.col("p_type").isin(*types), F.col("l_extendedprice"))).alias(f"mrc_{line}"),
            ]
            names.append(first_match(
                [(F.col(f"_{line}") == n, t) for n, t in enumerate(ordered)]).alias(f"{line}_nm"))
        grouped = lines.groupBy("l_orderkey").agg(*aggregates)
        return grouped.select("l_orderkey", "double_quantity", "lines", "mrc_vo", "mrc_tv", "mrc_bb", *names)

    @cached_property
    def snap(self) -> DataFrame:
        """Daily account snapshot, one row per account and day (the last order of the day)."""
        dt = F.to_date("o_orderdate")
        pending = F.col("o_orderstatus") == "P"
        rows = (
            self.table("orders")
            .join(self.order_lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_custkey").cast("string").alias("account"),
                dt.alias("dt"),
                F.col("o_orderkey").alias("order_id"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_orderpriority").alias("priority"),
                "vo_nm",
                F.coalesce("tv_nm", F.when(F.col("o_orderstatus") == "O", F.lit(""))).alias("tv_nm"),
                "bb_nm", "mrc_vo", "mrc_tv", "mrc_bb",
                F.col("o_totalprice").alias("bill_amt"),
                F.concat(F.lit("2"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("phone"),
                F.when(~pending, F.col("double_quantity")).alias("age"),
                F.date_sub(dt, F.col("lines")).alias("bill_dt"),
                F.date_add(F.date_sub(dt, F.col("lines")), 15).alias("due_dt"),
                F.date_sub(dt, (F.col("o_orderkey") % 90).cast("int")).alias("inst_dt"),
                F.date_sub(dt, F.col("lines") * 5).alias("last_pay_dt"),
            )
            .withColumn("unpaid_dt", oldest_unpaid(F.col("dt"), F.col("age")))
        )
        return keep_one(rows, ["account", "dt"], [F.desc("order_id")])

    @cached_property
    def profiled(self) -> DataFrame:
        """Snapshot with RGU flags, count, mix, technology, bundle name and rounded charge."""
        return rgu_flags(self.snap).withColumns({
            "num_rgus": rgu_count(), "mix": product_mix(), "tech": tech_flag("PROMO", "MEDIUM"), "bundle": bundle_name(),
            "charge": mrc_total(F.col("mrc_vo"), F.col("mrc_bb"), F.col("mrc_tv"))})

    @cached_property
    def account_firsts(self) -> DataFrame:
        """First day and latest installation of each account."""
        return self.snap.groupBy("account").agg(
            F.min("dt").alias("start_dt"), F.max("inst_dt").alias("max_inst_dt"))

    @cached_property
    def closing(self) -> DataFrame:
        """Last profiled row per account and quarter, with repaired age, account firsts and tenure."""
        return account_closing(repair_age(self.profiled), "quarter")

    @cached_property
    def service_orders(self) -> DataFrame:
        """Service orders of the order family; day of order is start and completion."""
        priority = F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").cast("string").alias("account"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), V.DEINSTALL)
            .when(priority == "3-MEDIUM", V.INSTALL).otherwise("TRASLADO").alias("order_type"),
            F.when(F.col("o_orderstatus") == "F", V.FINISHED).otherwise("PENDIENTE").alias("status"),
            pick(ORDER_COMMANDS, F.col("o_orderkey")).alias("command"),
            F.to_date("o_orderdate").alias("start"),
            F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 30).cast("int")).alias("completed"),
        )

    @cached_property
    def movement_log(self) -> DataFrame:
        """Movement log with an integer day key."""
        priority = F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_custkey").alias("contract"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("day_key"),
            F.to_date("o_orderdate").alias("day"),
            F.col("o_orderkey").alias("seq"),
            F.when(priority == "1-URGENT", V.LOG_LEAVE)
            .when(priority.isin("2-HIGH", "3-MEDIUM"), V.LOG_SWITCH).otherwise("ALTAS").alias("code"),
            F.when(F.col("o_orderstatus") == "F", V.LOG_OUT).otherwise(V.LOG_IN).alias("kind"),
            pick(LOG_DESCRIPTIONS, F.col("o_orderkey")).alias("description"),
        )

    @cached_property
    def mobile_closing(self) -> DataFrame:
        """Mobile lines per quarter: accounts whose last order of it is not low priority."""
        rows = self.table("orders").where(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
        dt = F.to_date("o_orderdate")
        rows = rows.select(
            F.concat(F.lit("7"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("mobile_account"),
            period_of(dt, "quarter").alias("period"),
            dt.alias("dt"),
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("fixed_contract"),
            F.when(F.col("o_orderstatus") != "O", F.round(F.col("o_totalprice") / 100000, 0)).alias("mrc"),
            F.date_sub(dt, (F.col("o_orderkey") % 400).cast("int")).alias("start_dt"),
            self._email(F.col("o_custkey")).alias("email"),
        )
        return keep_one(rows, ["mobile_account", "period"], [F.desc("dt"), F.desc("order_id")])

    @staticmethod
    def _email(custkey: Column) -> Column:
        """Two neighbours share an address; some have a placeholder."""
        return F.when(F.pmod(custkey, F.lit(11)) == 0, "NA@GMAIL.COM").otherwise(
            F.concat(F.lit("u"), F.floor(custkey / 2).cast("string"), F.lit("@mail.example")))

    @cached_property
    def fixed_emails(self) -> DataFrame:
        """Account and e-mail of every customer."""
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("account"),
            self._email(F.col("c_custkey") + 1).alias("email"))

    @cached_property
    def mobile_moves(self) -> DataFrame:
        """Mobile movement file, typed by the caller."""
        return self.table("orders").select(
            F.concat(F.lit("7"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("mobile_account"),
            F.to_date("o_orderdate").alias("day"),
            pick((V.MOBILE_LEAVE, V.MOBILE_LEAVE, V.MOBILE_OUT_MIGRATION, "Altas"),
                 F.col("o_orderkey")).alias("movement"),
            pick((V.MOBILE_INVOLUNTARY, V.MOBILE_PORT_OUT, V.MOBILE_VOLUNTARY, "OTRA"),
                 F.floor(F.col("o_orderkey") / 4)).alias("leave_kind"),
            F.when(F.col("o_orderstatus") == "P", V.MOBILE_VOLUNTARY).alias("migration_kind"),
        )

    @cached_property
    def gross_adds(self) -> DataFrame:
        """Sales file: text months (some empty), channel, seller, RGUs sold as text."""
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("account"),
            F.when(F.col("o_orderstatus") == "P", "").otherwise(
                F.date_format("o_orderdate", "yyyy-MM-dd")).alias("sales_day"),
            F.col("o_orderkey").alias("sale_id"),
            pick(SALE_CHANNELS, F.col("o_orderkey")).alias("channel"),
            F.col("o_orderpriority").alias("seller"),
            (F.col("o_orderkey") % 3 + 1).cast("string").alias("rgus_sold_text"),
        )

    # -- event family ------------------------------------------------------------------

    @cached_property
    def contacts(self) -> DataFrame:
        """Customer contacts from all events."""
        return self.table("events").select(
            F.col("event_id").alias("interaction_id"),
            F.col("user_id").cast("string").alias("account"),
            F.col("ts").cast("timestamp").alias("start"),
            F.to_date("ts").alias("day"),
            F.col("event_type").alias("purpose"),
            F.when(F.col("event_id") % 10 == 0, "ANULADA")
            .when(F.col("event_id") % 10 == 5, "CANCELADA").otherwise("CERRADA").alias("status"),
            F.regexp_extract("props", "[0-9]+", 0).alias("channel"),
            F.floor(F.col("value") / 100).cast("int").alias("agent"),
        )

    @cached_property
    def bills(self) -> DataFrame:
        """Daily charge rows of an account: every signup is a day with a charge.

        ``bill_dt`` is null on some days, as in the snapshot.
        """
        return self.table("events").where(F.col("event_type") == "signup").select(
            F.col("user_id").cast("string").alias("account"),
            F.to_date("ts").alias("dt"),
            F.col("event_id").alias("row_id"),
            F.when(F.col("value") >= 20, F.to_date("ts")).alias("bill_dt"),
            F.round("value", 2).alias("mrc"),
            (F.col("event_id") % 4).cast("int").alias("mix_qty"),
            *[F.when(F.col("event_id") % 4 >= n, F.concat(
                F.lit(f"{line}-"), (F.col("event_id") % 3).cast("string"))).alias(f"{line}_nm")
              for n, line in ((1, "bb"), (2, "tv"), (3, "vo"))],
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Payments with a text amount; every purchase is one."""
        return self.table("events").where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("payment_id"),
            F.col("user_id").cast("string").alias("account"),
            F.to_date("ts").alias("dt"),
            F.round("value", 2).cast("string").alias("amount_text"),
        )

    @cached_property
    def install_orders(self) -> DataFrame:
        """Installation orders: every signup starts one, completed some days later."""
        return self.table("events").where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").cast("string").alias("account"),
            F.lit(V.INSTALL).alias("order_type"),
            F.when(F.col("event_id") % 10 == 0, "CANCELADA").otherwise(V.FINISHED).alias("status"),
            F.to_date("ts").alias("start"),
            F.date_add(F.to_date("ts"), (F.col("value") / 25).cast("int")).alias("completed"),
            pick(SALE_CHANNELS, F.col("event_id")).alias("channel"),
        )

    @cached_property
    def usage(self) -> DataFrame:
        """Daily account rows of the event family: any event shows the account that day.

        Three kinds of event stand for the three services that the account held that day.
        """
        held = lambda kind: F.max(flag(F.col("event_type") == kind))
        return self.table("events").groupBy(
            F.col("user_id").cast("string").alias("account"), F.to_date("ts").alias("dt")
        ).agg(F.max(F.round(F.col("value"), 0)).cast("int").alias("age"),
              F.max(F.round("value", 2)).alias("mrc"), held("view").alias("rgu_bb"),
              held("click").alias("rgu_tv"), held("error").alias("rgu_vo"))

    @cached_property
    def dims(self) -> DataFrame:
        """Segment and province of every customer."""
        nation = self.table("nation").select("n_nationkey", "n_name")
        return (self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").cast("string").alias("account"),
                        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("province"),
                        F.col("c_nationkey").alias("nation_key")))
