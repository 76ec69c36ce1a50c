"""Report aggregations over the marts and the landed data. Means are given at display precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from remitlens.functions import classify as C
from remitlens.functions.numeric import (
    count_where,
    exact_mean,
    exact_sum,
    mean_of_counts,
    micro_sum,
    percent,
    round_half_up,
)
from remitlens.functions.text import currency_label, percent_label, raw_corridor_label
from remitlens.operators.filters import fill_zero
from remitlens.operators.ranking import top_k

ROWS = "*"

FRAUD_NUMBERS = (
    "total_calls",
    "failed_calls",
    "call_failure_rate_pct",
    "total_transfers",
    "total_transfer_usd",
    "fraud_transfers",
    "support_tickets",
    "fraud_tickets",
    "total_fraud_signals",
)


def fraud_frame(fraud_mart: DataFrame) -> DataFrame:
    """The mart columns the fraud reports show, with missing numbers as 0."""
    return fill_zero(fraud_mart.select("user_id", "fraud_risk_level", *FRAUD_NUMBERS), FRAUD_NUMBERS)


def customer_frame(customer_mart: DataFrame) -> DataFrame:
    return customer_mart.select(
        "user_id",
        "total_calls",
        "total_transfers",
        "total_payments",
        "total_revenue",
        "total_transfer_volume_usd",
        "customer_health_score",
        "customer_segment",
        "churn_risk",
    )


# --- fraud ---------------------------------------------------------------------------------------------------
def risk_distribution(fraud_mart: DataFrame) -> DataFrame:
    """Users per tier with their share; the window runs over the handful of tier rows."""
    counts = fraud_mart.groupBy("fraud_risk_level").agg(F.count("user_id").alias("user_count"))
    everyone = F.sum("user_count").over(Window.partitionBy())
    return counts.withColumn("share_pct", percent(F.col("user_count"), everyone, 1)).orderBy(
        F.desc("user_count"), "fraud_risk_level"
    )


def tier_exposure(fraud_mart: DataFrame) -> DataFrame:
    """One row per tier for all the per-tier charts, most severe first."""
    frame = fraud_frame(fraud_mart)
    return (
        frame.groupBy("fraud_risk_level")
        .agg(
            F.count("user_id").alias("users"),
            exact_sum(F.col("total_transfer_usd")).alias("exposure_usd"),
            mean_of_counts(F.col("total_fraud_signals")).alias("avg_signals"),
            F.sum("failed_calls").alias("failed_calls"),
            F.sum("fraud_transfers").alias("fraud_transfers"),
        )
        .withColumn("severity", C.severity_rank(F.col("fraud_risk_level")).cast("bigint"))
        .orderBy("severity", "fraud_risk_level")
    )


def signal_heatmap(fraud_mart: DataFrame, tiers: tuple[str, ...] = C.SEVERITY_ORDER) -> DataFrame:
    """Users per tier and signal bucket as a fixed-width grid; tiers outside the row list are left out."""
    bucket = C.signal_bucket(F.col("total_fraud_signals"))
    cells = [count_where(F.col("bucket") == label).alias(label) for label in C.SIGNAL_BUCKETS]
    return (
        fraud_mart.where(F.col("fraud_risk_level").isin(*tiers))
        .select("fraud_risk_level", bucket.alias("bucket"))
        .groupBy("fraud_risk_level")
        .agg(*cells)
        .orderBy(C.severity_rank(F.col("fraud_risk_level")))
    )


def _in_tier(*levels: str) -> Column:
    return count_where(F.col("fraud_risk_level").isin(*levels))


def elevated_risk_pct(fraud_mart: DataFrame) -> DataFrame:
    users = F.count(ROWS)
    return fraud_mart.agg(
        users.alias("users"),
        _in_tier("CRITICAL_RISK").alias("critical"),
        _in_tier("HIGH_RISK_FRAUD").alias("high"),
        percent(_in_tier(*C.ELEVATED_RISK), F.greatest(users, F.lit(1).cast("bigint"))).alias("elevated_pct"),
    )


def fraud_kpis(fraud_mart: DataFrame) -> DataFrame:
    users = F.count(ROWS)
    base = F.greatest(users, F.lit(1).cast("bigint"))
    return fraud_frame(fraud_mart).agg(
        users.alias("users"),
        _in_tier("CRITICAL_RISK").alias("critical"),
        percent(_in_tier("CRITICAL_RISK"), base).alias("critical_pct"),
        _in_tier("HIGH_RISK_FRAUD").alias("high"),
        percent(_in_tier("HIGH_RISK_FRAUD"), base).alias("high_pct"),
        mean_of_counts(F.col("total_fraud_signals")).alias("avg_signals"),
        exact_sum(F.col("total_transfer_usd")).alias("exposure_usd"),
    )


LEDGER_COLUMNS = (
    "user_id",
    "fraud_risk_level",
    "total_fraud_signals",
    "total_transfer_usd",
    "fraud_transfers",
    "call_failure_rate_pct",
    "failed_calls",
    "fraud_tickets",
)


def fraud_ledger(fraud_mart: DataFrame, k: int = 30) -> DataFrame:
    """The k accounts with most fraud signals, with display labels."""
    best = top_k(
        fraud_frame(fraud_mart).select(*LEDGER_COLUMNS), k, F.desc("total_fraud_signals"), F.asc("user_id")
    )
    return best.withColumns(
        {
            "transfer_label": currency_label(F.col("total_transfer_usd")),
            "failure_label": percent_label(F.col("call_failure_rate_pct")),
        }
    )


def fraud_ledger_by_exposure(fraud_mart: DataFrame) -> DataFrame:
    """Every account, ordered by signals, then exposure. The unique last key keeps the range sort even."""
    return fraud_frame(fraud_mart).orderBy(
        F.desc("total_fraud_signals"), F.desc("total_transfer_usd"), F.asc("user_id")
    )


def risk_profile(fraud_mart: DataFrame) -> DataFrame:
    """One point per user for the risk scatter plots."""
    return fraud_frame(fraud_mart).select(
        "user_id",
        "fraud_risk_level",
        "call_failure_rate_pct",
        "total_transfer_usd",
        "total_fraud_signals",
        "fraud_transfers",
        "fraud_tickets",
        "support_tickets",
    )


def money_labels(fraud_mart: DataFrame) -> DataFrame:
    frame = fraud_frame(fraud_mart)
    return frame.select(
        "user_id",
        "total_transfer_usd",
        currency_label(F.col("total_transfer_usd")).alias("transfer_label"),
        percent_label(F.col("call_failure_rate_pct")).alias("failure_label"),
    )


# --- executive -----------------------------------------------------------------------------------------------
def executive_kpis(
    fraud_mart: DataFrame, raw_cdrs: DataFrame, raw_transfers: DataFrame, raw_payments: DataFrame
) -> DataFrame:
    """One row from four tables: each contributes a one-row aggregate as a scalar subquery.

    The transfer total also counts the flags, which nobody reads: so it asks for the same columns as the fraud mart does, and
    both take the shuffled transfers from one exchange.
    """
    connected = count_where(F.col("connection_success"))
    calls = raw_cdrs.agg(
        F.struct(
            F.count(ROWS).alias("calls"),
            percent(connected, F.greatest(F.count(ROWS), F.lit(1).cast("bigint"))).alias("connection_pct"),
        ).alias("c")
    )
    volume = raw_transfers.agg(
        F.struct(_raw_total("transfer_amount_usd").alias("usd"), count_where(F.col("is_fraud_flag")).alias("flagged")).alias("v")
    )
    revenue = raw_payments.agg(_raw_total("payment_amount").alias("r"))
    users = fraud_mart.agg(F.count(ROWS).alias("users"), _in_tier(*C.ELEVATED_RISK).alias("high_risk_users"))
    return users.select("*", calls.scalar().alias("c"), volume.scalar().alias("v"), revenue.scalar().alias("r")).select(
        "users",
        "high_risk_users",
        F.col("c.calls").alias("calls"),
        F.col("c.connection_pct").alias("connection_pct"),
        F.col("v.usd").alias("transfer_volume_usd"),
        F.col("r").alias("payment_revenue_usd"),
    )


def executive_kpis_from_marts(
    fraud_mart: DataFrame, network_mart: DataFrame, corridor_mart: DataFrame, revenue_mart: DataFrame
) -> DataFrame:
    """The same row from the marts alone."""
    calls = network_mart.agg(
        F.struct(
            F.coalesce(F.max("total_calls"), F.lit(0).cast("bigint")).alias("calls"),
            F.coalesce(F.max("connection_success_rate_pct"), F.lit(0.0)).alias("connection_pct"),
        ).alias("c")
    )
    volume = corridor_mart.agg(F.coalesce(exact_sum(F.col("total_volume_usd")), F.lit(0.0)).alias("v"))
    revenue = revenue_mart.agg(F.coalesce(exact_sum(F.col("total_revenue")), F.lit(0.0)).alias("r"))
    users = fraud_mart.agg(F.count(ROWS).alias("users"), _in_tier(*C.ELEVATED_RISK).alias("high_risk_users"))
    return users.select("*", calls.scalar().alias("c"), volume.scalar().alias("v"), revenue.scalar().alias("r")).select(
        "users",
        "high_risk_users",
        F.col("c.calls").alias("calls"),
        F.col("c.connection_pct").alias("connection_pct"),
        F.col("v").alias("transfer_volume_usd"),
        F.col("r").alias("revenue_usd"),
    )


# --- customers -----------------------------------------------------------------------------------------------
def _users_and_health(customer_mart: DataFrame, *keys: str) -> DataFrame:
    return customer_mart.groupBy(*keys).agg(
        F.count("user_id").alias("users"),
        exact_mean(F.col("customer_health_score"), 1).alias("avg_health_score"),
    )


def segment_summary(customer_mart: DataFrame) -> DataFrame:
    return _users_and_health(customer_mart, "customer_segment").orderBy(F.desc("users"), "customer_segment")


def segment_churn_matrix(customer_mart: DataFrame) -> DataFrame:
    return _users_and_health(customer_mart, "customer_segment", "churn_risk").orderBy(
        F.desc("users"), "customer_segment", "churn_risk"
    )


def churn_distribution(customer_mart: DataFrame) -> DataFrame:
    return customer_mart.groupBy("churn_risk").agg(F.count("user_id").alias("user_count"))


def revenue_per_segment(customer_mart: DataFrame) -> DataFrame:
    return customer_mart.groupBy("customer_segment").agg(exact_mean(F.col("total_revenue")).alias("avg_revenue"))


def ticket_breakdown(raw_tickets: DataFrame) -> DataFrame:
    """Tickets per landed category and per landed status, from one pass: each ticket counts in both dimensions."""
    return (
        raw_tickets.unpivot([], ["issue_category", "ticket_status"], "dimension", "value")
        .where(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.count(ROWS).alias("tickets"))
    )


# --- network -------------------------------------------------------------------------------------------------
def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _raw_total(name: str) -> Column:
    """Total of landed amounts, rounded to cents at the end."""
    return round_half_up(micro_sum(_known(name)), 2)


def _raw_mean(name: str) -> Column:
    return round_half_up(micro_sum(_known(name)) / F.nullif(F.count(ROWS), F.lit(0).cast("bigint")), 2)


def cdr_stats(raw_cdrs: DataFrame) -> DataFrame:
    """Landed call statistics; missing values count as 0 in the means."""
    rows, connected = F.count(ROWS), count_where(F.col("connection_success"))
    return raw_cdrs.agg(
        rows.alias("total_calls"),
        connected.alias("connected"),
        percent(connected, F.greatest(rows, F.lit(1).cast("bigint"))).alias("conn_rate"),
        _raw_mean("call_quality_score").alias("avg_quality"),
        mean_of_counts(C.zero_if_null(F.col("duration_seconds"))).alias("avg_duration"),
        _raw_mean("delivery_rate_percent").alias("avg_delivery"),
    )


def cdr_top_users(raw_cdrs: DataFrame, k: int = 15) -> DataFrame:
    per_user = raw_cdrs.groupBy("user_id").agg(
        F.count(ROWS).alias("calls"),
        _raw_mean("call_quality_score").alias("avg_quality"),
        mean_of_counts(C.zero_if_null(F.col("duration_seconds"))).alias("avg_duration"),
    )
    return top_k(per_user, k, F.desc("calls"), F.asc("user_id"))


def sla_scorecard(network_mart: DataFrame) -> DataFrame:
    """Each SLA metric with its target, the gap to it and whether it is met."""
    targets = F.create_map(*[F.lit(item) for pair in C.SLA_TARGETS.items() for item in pair])
    cards = network_mart.unpivot([], list(C.SLA_TARGETS), "metric", "value")
    return cards.withColumn("target", targets[F.col("metric")]).select(
        "metric",
        "value",
        "target",
        round_half_up(F.col("value") - F.col("target"), 2).alias("gap"),
        (F.col("value") >= F.col("target")).alias("is_met"),
    )


# Chart labels of the two call breakdowns.
MOS_LABELS = {
    "excellent_calls": "Excellent (≥4.0)",
    "good_calls": "Good (3.0-3.9)",
    "fair_calls": "Fair (2.0-2.9)",
    "poor_calls": "Poor (<2.0)",
}
DURATION_LABELS = {
    "calls_no_connection": "No Conn",
    "calls_very_short": "Very Short",
    "calls_short": "Short",
    "calls_medium": "Medium",
    "calls_long": "Long",
}


def _breakdown(network_mart: DataFrame, labels: dict[str, str], name: str) -> DataFrame:
    renamed = network_mart.select(*[F.col(column).alias(label) for column, label in labels.items()])
    return renamed.unpivot([], [f"`{label}`" for label in labels.values()], name, "calls")


def mos_breakdown(network_mart: DataFrame) -> DataFrame:
    return _breakdown(network_mart, MOS_LABELS, "quality")


def duration_breakdown(network_mart: DataFrame) -> DataFrame:
    return _breakdown(network_mart, DURATION_LABELS, "bucket")


# --- revenue -------------------------------------------------------------------------------------------------
def payment_kpis(payments: DataFrame) -> DataFrame:
    """Success and failure count only the statuses named so; other statuses count as neither."""
    rows, amount, status = F.count(ROWS), F.col("payment_amount"), F.col("payment_status")
    base = F.greatest(rows, F.lit(1).cast("bigint"))
    return payments.agg(
        rows.alias("payments"),
        exact_sum(amount).alias("total_revenue"),
        exact_mean(amount).alias("avg_payment"),
        percent(count_where(status == "success"), base).alias("success_pct"),
        percent(count_where(status == "failed"), base).alias("failure_pct"),
    )


def plan_revenue(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("subscription_plan").isNotNull())
        .groupBy("subscription_plan")
        .agg(exact_sum(F.col("payment_amount")).alias("revenue"), F.count("transaction_id").alias("txns"))
        .orderBy(F.desc("revenue"), "subscription_plan")
    )


def payment_status_counts(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("payment_status").isNotNull())
        .groupBy("payment_status")
        .agg(F.count(ROWS).alias("payments"))
    )


def failure_rate_by_plan(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("subscription_plan").isNotNull())
        .groupBy("subscription_plan")
        .agg(percent(count_where(F.col("payment_status") == "failed"), F.count(ROWS)).alias("failure_rate"))
    )


def revenue_by_plan(revenue_mart: DataFrame) -> DataFrame:
    return (
        revenue_mart.where(F.col("latest_subscription_plan").isNotNull())
        .groupBy("latest_subscription_plan")
        .agg(
            F.count("user_id").alias("users"),
            exact_sum(F.col("total_revenue")).alias("total_revenue"),
            exact_mean(F.col("estimated_ltv")).alias("avg_ltv"),
        )
        .orderBy(F.desc("total_revenue"), "latest_subscription_plan")
    )


def chart_revenue_by_plan(revenue_mart: DataFrame, payment_facts: DataFrame) -> DataFrame:
    """Revenue rows joined to the payment facts, grouped by the fact's plan. One row per user on both sides."""
    plans = payment_facts.select("user_id", F.col("latest_subscription_plan").alias("plan"))
    return (
        revenue_mart.join(plans, "user_id")
        .groupBy(F.col("plan").alias("latest_subscription_plan"))
        .agg(
            F.count("user_id").alias("users"),
            exact_sum(F.col("total_revenue")).alias("total_revenue"),
            exact_mean(F.col("estimated_ltv")).alias("avg_ltv"),
        )
    )


# --- transfers and corridors ---------------------------------------------------------------------------------
def raw_fraud_signals(raw_transfers: DataFrame) -> DataFrame:
    rows, flagged = F.count(ROWS), count_where(F.col("is_fraud_flag"))
    return raw_transfers.agg(
        rows.alias("transfers"),
        flagged.alias("flagged"),
        percent(flagged, F.greatest(rows, F.lit(1).cast("bigint"))).alias("fraud_rate_pct"),
    )


def transfer_kpis(raw_transfers: DataFrame) -> DataFrame:
    return raw_transfers.agg(
        F.count(ROWS).alias("transfers"),
        _raw_total("transfer_amount_usd").alias("total_volume"),
        _raw_mean("transfer_amount_usd").alias("avg_transfer"),
        F.max(_known("transfer_amount_usd")).alias("max_transfer"),
    )


def transfer_size_labels(raw_transfers: DataFrame) -> DataFrame:
    return raw_transfers.groupBy(C.size_label(_known("transfer_amount_usd")).alias("size_label")).agg(
        F.count(ROWS).alias("transfers")
    )


def sender_top(raw_transfers: DataFrame, k: int = 12) -> DataFrame:
    """The k largest sending countries, smallest first, as the chart draws them."""
    volume = (
        raw_transfers.where(F.col("sender_country").isNotNull())
        .groupBy("sender_country")
        .agg(_raw_total("transfer_amount_usd").alias("volume"))
    )
    return top_k(volume, k, F.desc("volume"), F.asc("sender_country")).orderBy("volume", F.desc("sender_country"))


def raw_corridor_top(raw_transfers: DataFrame, k: int = 15) -> DataFrame:
    label = raw_corridor_label(F.col("sender_country"), F.col("receiver_country"))
    routes = (
        raw_transfers.groupBy(label.alias("corridor"))
        .agg(_raw_total("transfer_amount_usd").alias("volume"), F.count(ROWS).alias("transfers"))
        .where(F.col("corridor").isNotNull())
    )
    return top_k(routes, k, F.desc("volume"), F.asc("corridor"))


_BY_VOLUME = ("total_volume_usd", "sender_country", "receiver_country")


def corridor_topk(corridor_mart: DataFrame, k: int = 20) -> DataFrame:
    best = top_k(corridor_mart, k, F.desc(_BY_VOLUME[0]), F.asc(_BY_VOLUME[1]), F.asc(_BY_VOLUME[2]))
    return best.select("corridor", "corridor_risk", "total_transfers", "total_volume_usd", "fraud_rate_pct")


def corridor_risk_register(corridor_mart: DataFrame) -> DataFrame:
    ordered = corridor_mart.orderBy(F.desc(_BY_VOLUME[0]), F.asc(_BY_VOLUME[1]), F.asc(_BY_VOLUME[2]))
    return ordered.select(
        "corridor",
        "corridor_risk",
        "total_transfers",
        "total_volume_usd",
        "avg_transfer_usd",
        "fraud_count",
        "fraud_rate_pct",
    )
