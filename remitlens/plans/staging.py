"""Staging models: typed, cleaned, one row per landed row with usable keys. Valid on batches and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions import classify as C
from remitlens.functions.numeric import round_half_up
from remitlens.functions.text import clean_lower, clean_upper, corridor_name


def _with_keys(raw: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        raw = raw.where(F.col(key).isNotNull())
    return raw


def stg_tickets(raw: DataFrame) -> DataFrame:
    created, updated = F.col("created_at").cast("timestamp"), F.col("updated_at").cast("timestamp")
    return _with_keys(raw, "ticket_id", "user_id").select(
        "ticket_id",
        "user_id",
        created.alias("created_at"),
        updated.alias("updated_at"),
        *[clean_lower(F.col(name)).alias(name) for name in ("issue_category", "priority", "ticket_status")],
        "satisfaction_score",
        "_airbyte_ab_id",
        "_airbyte_emitted_at",
        F.timestamp_diff("HOUR", created, updated).alias("resolution_hours"),
    )


def stg_cdrs(raw: DataFrame) -> DataFrame:
    return _with_keys(raw, "call_id", "user_id").select(
        "call_id",
        "user_id",
        C.zero_if_null(F.col("duration_seconds")).alias("duration_seconds"),
        F.coalesce("connection_success", F.lit(False)).alias("connection_success"),
        round_half_up(F.coalesce("call_quality_score", F.lit(0.0)), 2).alias("call_quality_score"),
        round_half_up(F.coalesce("delivery_rate_percent", F.lit(0.0)), 2).alias("delivery_rate_percent"),
        F.col("timestamp").cast("timestamp").alias("event_timestamp"),
        C.duration_bucket(F.col("duration_seconds")).alias("call_duration_bucket"),
        C.quality_tier(F.col("call_quality_score")).alias("quality_tier"),
    )


def stg_transfers(raw: DataFrame) -> DataFrame:
    cleaned = _with_keys(raw, "transfer_id", "user_id").withColumns(
        {name: clean_upper(F.col(name)) for name in ("sender_country", "receiver_country")}
    )
    return cleaned.select(
        "transfer_id",
        "user_id",
        "sender_country",
        "receiver_country",
        round_half_up(F.coalesce("transfer_amount_usd", F.lit(0.0)), 2).alias("transfer_amount_usd"),
        F.coalesce("is_fraud_flag", F.lit(False)).alias("is_fraud_flag"),
        C.size_tier(F.col("transfer_amount_usd")).alias("transfer_size_tier"),
        corridor_name(F.col("sender_country"), F.col("receiver_country")).alias("corridor"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    cleaned = _with_keys(raw, "transaction_id", "user_id").withColumns(
        {name: clean_lower(F.col(name)) for name in ("subscription_plan", "payment_status")}
    )
    return cleaned.select(
        "transaction_id",
        "user_id",
        "subscription_plan",
        round_half_up(F.coalesce("payment_amount", F.lit(0.0)), 2).alias("payment_amount"),
        "payment_status",
        C.payment_succeeded(F.col("payment_status")).alias("is_payment_successful"),
    )
