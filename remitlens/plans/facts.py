"""Per-user fact tables. Every aggregate combines on the map side, so a user holding a large share of all rows
reaches the reducers as a handful of partial rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numeric import (
    count_where,
    exact_mean,
    half_away_div,
    mean_of_counts,
    percent,
    scaled,
)
from remitlens.functions.text import corridor_name


def _as_double(value: Column) -> Column:
    return value.cast("double")


def call_metrics() -> list[Column]:
    """Metrics per user of the call staging table; none needs a distinct, so streams can use them too."""
    rows = F.count(F.lit(1))
    failed = count_where(~F.col("connection_success"))
    duration = F.col("duration_seconds")
    return [
        rows.alias("total_calls"),
        failed.alias("failed_calls"),
        count_where(F.col("connection_success")).alias("successful_calls"),
        mean_of_counts(duration).alias("avg_duration_seconds"),
        _as_double(F.max(duration)).alias("max_duration_seconds"),
        _as_double(F.sum(duration)).alias("total_duration_seconds"),
        exact_mean(F.col("call_quality_score")).alias("avg_quality_score"),
        F.min("call_quality_score").alias("min_quality_score"),
        exact_mean(F.col("delivery_rate_percent")).alias("avg_delivery_rate_pct"),
        percent(failed, rows).alias("call_failure_rate_pct"),
        count_where(F.col("call_duration_bucket") == "no_connection").alias("no_connection_calls"),
        count_where(F.col("quality_tier") == "poor").alias("poor_quality_calls"),
        count_where(F.col("quality_tier") == "excellent").alias("excellent_quality_calls"),
    ]


def fct_telecom_calls(stg_cdrs: DataFrame) -> DataFrame:
    return stg_cdrs.groupBy("user_id").agg(*call_metrics())


def _transfer_totals(
    *, rows: Column, cents: Column, top: Column, low: Column, frauds: Column, very_large: Column, micro: Column
) -> list[Column]:
    return [
        rows.alias("total_transfers"),
        (cents / 100.0).alias("total_transfer_usd"),
        (half_away_div(cents, rows) / 100.0).alias("avg_transfer_usd"),
        top.alias("max_transfer_usd"),
        low.alias("min_transfer_usd"),
        frauds.alias("fraud_transfers"),
        percent(frauds, rows).alias("fraud_rate_pct"),
        very_large.alias("very_large_transfers"),
        micro.alias("micro_transfers"),
    ]


def transfer_totals(stg_transfers: DataFrame) -> DataFrame:
    """The transfer fact without its distinct counts: all a mart needs, and it reads neither country nor corridor."""
    usd, tier = F.col("transfer_amount_usd"), F.col("transfer_size_tier")
    totals = _transfer_totals(
        rows=F.count("*"),
        cents=F.sum(scaled(usd)),
        top=F.max(usd),
        low=F.min(usd),
        frauds=count_where(F.col("is_fraud_flag")),
        very_large=count_where(tier == "very_large"),
        micro=count_where(tier == "micro"),
    )
    return stg_transfers.groupBy("user_id").agg(*totals)


# Partial aggregates of a user's route, and how two of them are merged.
ROUTE_KEYS = ("user_id", "sender_country", "receiver_country")
_MERGED = {
    "n": F.sum, "cents": F.sum, "top": F.max, "low": F.min, "frauds": F.sum, "very_large": F.sum, "micro": F.sum
}


def route_partials(stg_transfers: DataFrame) -> DataFrame:
    """One row per user and route (NULL ends included): counts, hundredths and extremes, which merge exactly."""
    usd, tier = F.col("transfer_amount_usd"), F.col("transfer_size_tier")
    return stg_transfers.groupBy(*ROUTE_KEYS).agg(
        F.count("*").alias("n"),
        F.sum(scaled(usd)).alias("cents"),
        F.max(usd).alias("top"),
        F.min(usd).alias("low"),
        count_where(F.col("is_fraud_flag")).alias("frauds"),
        count_where(tier == "very_large").alias("very_large"),
        count_where(tier == "micro").alias("micro"),
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of any number of parts of the transfers as those of all of them."""
    return partials.groupBy(*ROUTE_KEYS).agg(*[merge(name).alias(name) for name, merge in _MERGED.items()])


def transfers_of_routes(per_route: DataFrame) -> DataFrame:
    """The transfer fact from one row per user and route.

    A route is a row of its own, so the corridors are the routes with both ends known (country names must not contain
    the arrow that joins them), and the distinct countries are small collected sets, bounded by the number of countries in
    the world. Distinct aggregates would expand the rows once for each count.
    """
    totals = _transfer_totals(
        rows=F.sum("n"),
        cents=F.sum("cents"),
        top=F.max("top"),
        low=F.min("low"),
        frauds=F.sum("frauds"),
        very_large=F.sum("very_large"),
        micro=F.sum("micro"),
    )
    corridor = corridor_name(F.col("sender_country"), F.col("receiver_country"))
    return per_route.groupBy("user_id").agg(
        *totals,
        F.size(F.collect_set("sender_country")).cast("bigint").alias("distinct_sender_countries"),
        F.size(F.collect_set("receiver_country")).cast("bigint").alias("distinct_receiver_countries"),
        F.count(corridor).alias("distinct_corridors"),
    )


def fct_financial_transfers(stg_transfers: DataFrame) -> DataFrame:
    """Two steps and two shuffles: per user and route, which bounds a hot user to their routes, then per user."""
    return transfers_of_routes(route_partials(stg_transfers))


def fct_support_tickets(stg_tickets: DataFrame) -> DataFrame:
    def having(column: str, value: str) -> Column:
        return count_where(F.col(column) == value)

    return stg_tickets.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        having("issue_category", "fraud_alert").alias("fraud_tickets"),
        having("issue_category", "payment_failure").alias("payment_failure_tickets"),
        having("issue_category", "call_drop").alias("call_drop_tickets"),
        having("issue_category", "topup_delay").alias("topup_delay_tickets"),
        mean_of_counts(F.col("satisfaction_score")).alias("avg_satisfaction_score"),
        mean_of_counts(F.col("resolution_hours")).alias("avg_resolution_hours"),
        having("ticket_status", "open").alias("open_tickets"),
        having("ticket_status", "pending").alias("pending_tickets"),
        having("ticket_status", "solved").alias("solved_tickets"),
        having("ticket_status", "closed").alias("closed_tickets"),
        having("priority", "urgent").alias("urgent_tickets"),
        having("priority", "high").alias("high_priority_tickets"),
    )


def fct_payments(stg_payments: DataFrame) -> DataFrame:
    """Two steps: per user and plan, then per user.

    The text maximum needs a sort-based aggregate; it runs on one row per user and plan, and the distinct plan
    count becomes a plain count.
    """
    paid = F.col("is_payment_successful")
    per_plan = stg_payments.groupBy("user_id", "subscription_plan").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(scaled(F.col("payment_amount"))).alias("cents"),
        count_where(paid).alias("succeeded"),
        count_where(~paid).alias("failed"),
    )
    rows, cents, failed = F.sum("n"), F.sum("cents"), F.sum("failed")
    return per_plan.groupBy("user_id").agg(
        rows.alias("total_payments"),
        (cents / 100.0).alias("total_payment_amount"),
        (half_away_div(cents, rows) / 100.0).alias("avg_payment_amount"),
        F.sum("succeeded").alias("successful_payments"),
        failed.alias("failed_payments"),
        percent(failed, rows).alias("payment_failure_rate_pct"),
        F.count("subscription_plan").alias("distinct_plans"),
        F.max("subscription_plan").alias("latest_subscription_plan"),
    )
