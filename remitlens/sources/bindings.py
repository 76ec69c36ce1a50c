"""Binds the supplied star-schema tables to the four raw inputs.

Only columns that are used reach the scans. Nothing is broadcast by hint: the country table and any other small
side are broadcast by Spark itself when their measured size allows it, and AQE splits skewed join keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceTables:
    """The supplied tables by name; each is opened once, however many inputs use it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._opened[name]


def _id(prefix: str, *keys: str) -> Column:
    parts = [F.col(key).cast("string") for key in keys]
    return F.concat(F.lit(f"{prefix}-"), F.concat_ws("-", *parts))


def _null_every(key: str, step: int, value: Column) -> Column:
    """Plant a NULL in every ``step``-th row."""
    return F.when(F.col(key) % step != 0, value)


def calls_from_events(events: DataFrame) -> DataFrame:
    """raw_cdrs from the event table; also valid on a stream of events."""
    failed = F.col("event_type") == "error"
    event = F.col("event_id")
    duration = F.when(failed, F.floor("value") % 31).otherwise(F.floor(F.col("value") * 20))
    quality = F.when(failed, F.lit(0.5) + ((event * 37) % 1501).cast("double") / 1000).otherwise(
        F.lit(1.0) + ((event * 37) % 4001).cast("double") / 1000
    )
    delivery = F.when(failed, ((event * 17) % 5001).cast("double") / 100).otherwise(
        F.lit(70.0) + ((event * 13) % 3000).cast("double") / 100
    )
    return events.where(~((F.col("user_id") % 10 == 5) & (event % 4 != 0))).select(
        _id("CALL", "event_id").alias("call_id"),
        _id("USR", "user_id").alias("user_id"),
        _null_every("event_id", 97, duration).alias("duration_seconds"),
        _null_every("event_id", 89, ~failed).alias("connection_success"),
        _null_every("event_id", 83, quality).alias("call_quality_score"),
        _null_every("event_id", 79, delivery).alias("delivery_rate_percent"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def raw_cdrs(tables: SourceTables) -> DataFrame:
    return calls_from_events(tables["events"])


def raw_transfers(tables: SourceTables) -> DataFrame:
    """Senders are resolved on the orders, so the far larger item rows are shuffled for one join less.

    Items and orders grow together, so their join is declared a sort-merge join: neither side is ever broadcast, however
    small an estimate looks. Countries travel as keys; their names are looked up at the end.
    """
    nation = tables["nation"].select("n_nationkey", F.lower("n_name").alias("country"))
    home = nation.select(F.col("n_nationkey").alias("home_key"), F.col("country").alias("sender"))
    away = nation.select(F.col("n_nationkey").alias("away_key"), F.col("country").alias("receiver"))
    sent_orders = (
        tables["orders"]
        .where(F.col("o_custkey") % 5 != 0)
        .join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "c_nationkey")
    )
    suspicious = (
        (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.045) & (F.col("o_custkey") % 4 == 1)
    )
    return (
        tables["lineitem"]
        .hint("merge")
        .join(sent_orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(tables["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(home, F.col("c_nationkey") == F.col("home_key"))
        .join(away, F.col("s_nationkey") == F.col("away_key"))
        .select(
            _id("TRF", "l_orderkey", "l_linenumber").alias("transfer_id"),
            _id("USR", "o_custkey").alias("user_id"),
            F.concat(F.lit(" "), F.col("sender")).alias("sender_country"),
            _null_every("l_orderkey", 101, F.concat(F.col("receiver"), F.lit(" "))).alias("receiver_country"),
            _null_every("l_orderkey", 103, F.col("l_extendedprice") / 50).alias("transfer_amount_usd"),
            _null_every("l_orderkey", 107, suspicious).alias("is_fraud_flag"),
        )
    )


def raw_payments(tables: SourceTables) -> DataFrame:
    customer = tables["customer"].select("c_custkey", "c_mktsegment")
    order = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Success "))
        .when((F.col("o_orderstatus") == "O") & (order % 2 == 0), F.lit("PAID"))
        .when(F.col("o_orderstatus") == "O", F.lit("pending"))
        .when(order % 3 == 0, F.lit("refunded"))
        .otherwise(F.lit("Failed"))
    )
    return (
        tables["orders"]
        .where(F.col("o_custkey") % 7 != 0)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            _id("TXN", "o_orderkey").alias("transaction_id"),
            _id("USR", "o_custkey").alias("user_id"),
            F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("subscription_plan"),
            _null_every("o_orderkey", 109, F.col("o_totalprice") / 5000).alias("payment_amount"),
            status.alias("payment_status"),
        )
    )


def raw_tickets(tables: SourceTables) -> DataFrame:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    opened = F.col("o_orderdate").cast("timestamp")
    minutes = ((order * 7) % 5000).cast("int")
    category = (
        F.when((customer % 6 == 1) & (order % 4 == 0), F.lit(" Fraud_Alert"))
        .when(order % 3 == 0, F.lit("PAYMENT_FAILURE "))
        .when(order % 3 == 1, F.lit("call_drop"))
        .otherwise(F.lit("Topup_Delay"))
    )
    status = (
        F.when(order % 4 == 0, F.lit("Open"))
        .when(order % 4 == 1, F.lit("pending "))
        .when(order % 4 == 2, F.lit("SOLVED"))
        .otherwise(F.lit("closed"))
    )
    loaded_at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return (
        tables["orders"]
        .where(order % 10 < 3)
        .select(
            _id("ZD", "o_orderkey").alias("ticket_id"),
            _id("USR", "o_custkey").alias("user_id"),
            opened.alias("created_at"),
            (opened + F.make_dt_interval(mins=minutes)).alias("updated_at"),
            category.alias("issue_category"),
            F.expr("substring(o_orderpriority, 3)").alias("priority"),
            status.alias("ticket_status"),
            _null_every("o_orderkey", 19, 1 + order % 5).alias("satisfaction_score"),
            _id("AB", "o_orderkey").alias("_airbyte_ab_id"),
            loaded_at.alias("_airbyte_emitted_at"),
            loaded_at.alias("_airbyte_normalized_at"),
        )
    )


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, so that results do not depend on the reader's time zone."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


RAW_INPUTS = {
    "raw_tickets": raw_tickets,
    "raw_cdrs": raw_cdrs,
    "raw_transfers": raw_transfers,
    "raw_payments": raw_payments,
}
