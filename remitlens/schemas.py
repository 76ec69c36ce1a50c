"""Schemas of the raw inputs and the names of all model tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _LONG, _DOUBLE, _FLAG, _INSTANT = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

TICKET_SOURCE = _schema(
    ("ticket_id", _TEXT),
    ("user_id", _TEXT),
    ("created_at", _INSTANT),
    ("updated_at", _INSTANT),
    ("issue_category", _TEXT),
    ("priority", _TEXT),
    ("ticket_status", _TEXT),
    ("satisfaction_score", _LONG),
)
AUDIT_COLUMNS = ("_airbyte_ab_id", "_airbyte_emitted_at", "_airbyte_normalized_at")
TICKETS = T.StructType(
    TICKET_SOURCE.fields
    + _schema(
        ("_airbyte_ab_id", _TEXT), ("_airbyte_emitted_at", _INSTANT), ("_airbyte_normalized_at", _INSTANT)
    ).fields
)
CDRS = _schema(
    ("call_id", _TEXT),
    ("user_id", _TEXT),
    ("duration_seconds", _LONG),
    ("connection_success", _FLAG),
    ("call_quality_score", _DOUBLE),
    ("delivery_rate_percent", _DOUBLE),
    ("timestamp", _INSTANT),
)
TRANSFERS = _schema(
    ("transfer_id", _TEXT),
    ("user_id", _TEXT),
    ("sender_country", _TEXT),
    ("receiver_country", _TEXT),
    ("transfer_amount_usd", _DOUBLE),
    ("is_fraud_flag", _FLAG),
)
PAYMENTS = _schema(
    ("transaction_id", _TEXT),
    ("user_id", _TEXT),
    ("subscription_plan", _TEXT),
    ("payment_amount", _DOUBLE),
    ("payment_status", _TEXT),
)

RAW_SCHEMAS = {
    "raw_tickets": TICKETS,
    "raw_cdrs": CDRS,
    "raw_transfers": TRANSFERS,
    "raw_payments": PAYMENTS,
}
# Key columns that must be present in every loaded row.
REQUIRED = {
    "raw_tickets": ("ticket_id", "user_id"),
    "raw_cdrs": ("call_id", "user_id"),
    "raw_transfers": ("transfer_id", "user_id"),
    "raw_payments": ("transaction_id", "user_id"),
}
RAW_TABLES = tuple(RAW_SCHEMAS)


def required_of(schema: T.StructType) -> tuple[str, ...]:
    """The required columns of a raw schema; none for other schemas."""
    return next((REQUIRED[name] for name, raw in RAW_SCHEMAS.items() if raw == schema), ())


STAGING_TABLES = ("stg_tickets", "stg_cdrs", "stg_transfers", "stg_payments")
FACT_TABLES = ("fct_telecom_calls", "fct_financial_transfers", "fct_support_tickets", "fct_payments")
MART_TABLES = (
    "mart_fraud_prevention",
    "mart_customer_360",
    "mart_revenue_analytics",
    "mart_network_quality",
    "mart_corridor_analytics",
)
LAYERS = {
    **{name: "RAW" for name in RAW_TABLES},
    **{name: "STAGING" for name in STAGING_TABLES},
    **{name: "FACT" for name in FACT_TABLES},
    **{name: "MART" for name in MART_TABLES},
}
