"""Analytics marts on top of the facts.

The cross-domain marts need one row per user over several facts, whatever the facts a user appears in. Every fact
holds at most one row per user, so stacking the facts and grouping by user gives the same rows as a chain of full
outer joins. It reuses the hash partitioning the facts already have, where each full outer join after the first
would shuffle everything again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions import classify as C
from remitlens.functions.numeric import count_where, exact_mean, exact_sum, mean_of_counts, percent
from remitlens.functions.text import corridor_name

CALL_COLUMNS = (
    "total_calls",
    "failed_calls",
    "call_failure_rate_pct",
    "avg_quality_score",
    "avg_delivery_rate_pct",
    "poor_quality_calls",
)
TRANSFER_COLUMNS = (
    "total_transfers",
    "total_transfer_usd",
    "avg_transfer_usd",
    "fraud_transfers",
    "fraud_rate_pct",
    "very_large_transfers",
)
TICKET_COLUMNS = ("total_tickets", "fraud_tickets", "avg_satisfaction_score", "avg_resolution_hours")
PAYMENT_COLUMNS = (
    "total_payments",
    "total_payment_amount",
    "payment_failure_rate_pct",
    "latest_subscription_plan",
)


def one_row_per_user(facts: list[tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Align facts on user_id: all users of any fact, NULL where a fact has no row for the user."""
    parts = [fact.select("user_id", *columns) for fact, columns in facts]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    columns = [name for _, names in facts for name in names]
    return stacked.groupBy("user_id").agg(*[F.max(name).alias(name) for name in columns])


def _refreshed(df: DataFrame, name: str = "refreshed_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def _risk_of_row() -> Column:
    return C.fraud_risk_level(
        fraud_transfers=F.col("fraud_transfers"),
        fraud_tickets=F.col("fraud_tickets"),
        failure_pct=F.col("call_failure_rate_pct"),
        transfer_usd=F.col("total_transfer_usd"),
        very_large=F.col("very_large_transfers"),
        tickets=F.col("total_tickets"),
    )


def mart_fraud_prevention(calls: DataFrame, transfers: DataFrame, tickets: DataFrame) -> DataFrame:
    ticket_columns = tuple(name for name in TICKET_COLUMNS if name != "avg_resolution_hours")
    users = one_row_per_user([(calls, CALL_COLUMNS), (transfers, TRANSFER_COLUMNS), (tickets, ticket_columns)])
    return _refreshed(
        users.select(
            "user_id",
            *CALL_COLUMNS,
            *TRANSFER_COLUMNS,
            F.col("total_tickets").alias("support_tickets"),
            "fraud_tickets",
            "avg_satisfaction_score",
            C.fraud_signals(F.col("fraud_transfers"), F.col("fraud_tickets")).alias("total_fraud_signals"),
            _risk_of_row().alias("fraud_risk_level"),
        ),
        "mart_refreshed_at",
    )


def mart_customer_360(
    calls: DataFrame, transfers: DataFrame, tickets: DataFrame, payments: DataFrame
) -> DataFrame:
    """The risk level is derived from the same aligned row the fraud mart is built on, so the facts are neither
    read nor joined a second time. Users known only from payments have no risk level."""
    aligned = one_row_per_user(
        [
            (calls, ("total_calls", "avg_quality_score", "call_failure_rate_pct")),
            (
                transfers,
                ("total_transfers", "total_transfer_usd", "fraud_transfers", "very_large_transfers"),
            ),
            (tickets, TICKET_COLUMNS),
            (payments, PAYMENT_COLUMNS),
        ]
    )
    in_fraud_mart = F.coalesce("total_calls", "total_transfers", "total_tickets").isNotNull()
    users = aligned.withColumn("fraud_risk_level", F.when(in_fraud_mart, _risk_of_row()))

    def count_of(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    def amount_of(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    return _refreshed(
        users.select(
            "user_id",
            count_of("total_calls").alias("total_calls"),
            count_of("total_transfers").alias("total_transfers"),
            count_of("total_payments").alias("total_payments"),
            count_of("total_tickets").alias("total_support_tickets"),
            (count_of("total_calls") + count_of("total_transfers") + count_of("total_payments")).alias(
                "total_activity_events"
            ),
            amount_of("total_payment_amount").alias("total_revenue"),
            amount_of("total_transfer_usd").alias("total_transfer_volume_usd"),
            "latest_subscription_plan",
            amount_of("avg_quality_score").alias("call_quality_score"),
            amount_of("call_failure_rate_pct").alias("call_failure_rate_pct"),
            amount_of("avg_satisfaction_score").alias("support_satisfaction_score"),
            amount_of("avg_resolution_hours").alias("avg_ticket_resolution_hours"),
            "fraud_risk_level",
            amount_of("payment_failure_rate_pct").alias("payment_failure_rate_pct"),
            C.health_score(
                quality=F.col("avg_quality_score"),
                satisfaction=F.col("avg_satisfaction_score"),
                failure_pct=F.col("call_failure_rate_pct"),
                risk_level=F.col("fraud_risk_level"),
            ).alias("customer_health_score"),
            C.customer_segment(
                revenue=F.col("total_payment_amount"),
                calls=F.col("total_calls"),
                transfers=F.col("total_transfers"),
                transfer_usd=F.col("total_transfer_usd"),
            ).alias("customer_segment"),
            C.churn_risk(
                tickets=F.col("total_tickets"),
                satisfaction=F.col("avg_satisfaction_score"),
                failure_pct=F.col("call_failure_rate_pct"),
            ).alias("churn_risk"),
        )
    )


def mart_revenue_analytics(payments: DataFrame, calls: DataFrame, transfers: DataFrame) -> DataFrame:
    """All three sides are partitioned by user_id already, so the left joins add no shuffle."""
    joined = payments.join(calls.select("user_id", "total_calls"), "user_id", "left").join(
        transfers.select("user_id", "total_transfers", "total_transfer_usd"), "user_id", "left"
    )
    revenue = F.col("total_payment_amount")
    return _refreshed(
        joined.select(
            "user_id",
            "latest_subscription_plan",
            "total_payments",
            revenue.alias("total_revenue"),
            F.col("avg_payment_amount").alias("avg_revenue_per_txn"),
            "successful_payments",
            "failed_payments",
            "payment_failure_rate_pct",
            F.coalesce("total_transfer_usd", F.lit(0.0)).alias("transfer_volume_usd"),
            C.unit_value(revenue, F.col("total_calls")).alias("revenue_per_call"),
            C.unit_value(revenue, F.col("total_transfers")).alias("revenue_per_transfer"),
            C.lifetime_value(revenue, F.col("total_transfer_usd")).alias("estimated_ltv"),
        )
    )


def mart_network_quality(stg_cdrs: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    connected = count_where(F.col("connection_success"))

    def tier(name: str) -> Column:
        return count_where(F.col("quality_tier") == name)

    def bucket(name: str) -> Column:
        return count_where(F.col("call_duration_bucket") == name)

    totals = stg_cdrs.agg(
        rows.alias("total_calls"),
        connected.alias("connected_calls"),
        count_where(~F.col("connection_success")).alias("dropped_calls"),
        percent(connected, rows).alias("connection_success_rate_pct"),
        mean_of_counts(F.col("duration_seconds")).alias("avg_call_duration_sec"),
        exact_mean(F.col("call_quality_score")).alias("avg_mos_score"),
        exact_mean(F.col("delivery_rate_percent")).alias("avg_delivery_rate_pct"),
        *[tier(name).alias(f"{name}_calls") for name in ("excellent", "good", "fair", "poor")],
        percent(count_where(F.col("call_quality_score") >= 3.0), rows).alias("sla_quality_met_pct"),
        percent(connected, rows).alias("sla_connection_met_pct"),
        *[
            bucket(name).alias(f"calls_{name}")
            for name in ("no_connection", "very_short", "short", "medium", "long")
        ],
    )
    return _refreshed(totals.select(F.lit("OVERALL").alias("dimension"), "*"))


def mart_corridor_analytics(stg_transfers: DataFrame) -> DataFrame:
    """The sender count makes Spark aggregate per route and sender first, so a route carrying a third of all transfers
    is spread over many tasks. Reports that do not show the sender count prune that step. The corridor name follows
    from the route and is added at the end."""
    usd, flagged = F.col("transfer_amount_usd"), F.col("is_fraud_flag")
    rows, frauds = F.count("*"), count_where(flagged)
    sizes = ("micro", "small", "medium", "large", "very_large")
    totals = stg_transfers.groupBy("sender_country", "receiver_country").agg(
        rows.alias("total_transfers"),
        F.count_distinct("user_id").alias("unique_senders"),
        exact_sum(usd).alias("total_volume_usd"),
        exact_mean(usd).alias("avg_transfer_usd"),
        F.max(usd).alias("max_transfer_usd"),
        frauds.alias("fraud_count"),
        percent(frauds, rows).alias("fraud_rate_pct"),
        *[count_where(F.col("transfer_size_tier") == size).alias(f"{size}_transfers") for size in sizes],
    )
    corridor = corridor_name(F.col("sender_country"), F.col("receiver_country"))
    risk = C.corridor_risk(F.col("fraud_count"), F.col("fraud_rate_pct"))
    route, measures = totals.columns[:2], totals.columns[2:]
    return _refreshed(totals.select(*route, corridor.alias("corridor"), *measures, risk.alias("corridor_risk")))
