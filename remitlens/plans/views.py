"""Reporting views on the marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions.classify import CHURN_LEVELS
from remitlens.functions.numeric import count_where, exact_mean, exact_sum, half_away_div, scaled
from remitlens.operators.ranking import ranked_top_k


def vw_fraud_summary(fraud_mart: DataFrame) -> DataFrame:
    return fraud_mart.groupBy("fraud_risk_level").agg(
        F.count(F.lit(1)).alias("users"),
        exact_sum(F.coalesce("total_transfer_usd", F.lit(0.0))).alias("exposure_usd"),
    )


def vw_customer_health(customer_mart: DataFrame) -> DataFrame:
    churn = F.col("churn_risk")
    names = ("high_churn_users", "moderate_churn_users", "stable_users")
    return customer_mart.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("users"),
        exact_mean(F.col("customer_health_score"), 1).alias("avg_health_score"),
        *[count_where(churn == level).alias(name) for level, name in zip(CHURN_LEVELS, names)],
        exact_sum(F.col("total_revenue")).alias("total_revenue"),
    )


def vw_revenue_by_plan(revenue_mart: DataFrame) -> DataFrame:
    cents, payments = F.sum(scaled(F.col("total_revenue"))), F.sum("total_payments")
    return revenue_mart.groupBy("latest_subscription_plan").agg(
        (cents / 100.0).alias("total_revenue"),
        payments.alias("total_transactions"),
        (half_away_div(cents, payments) / 100.0).alias("avg_spend"),
    )


def vw_corridor_top20(corridor_mart: DataFrame) -> DataFrame:
    order = (F.desc("total_volume_usd"), F.asc("sender_country"), F.asc("receiver_country"))
    return ranked_top_k(corridor_mart, 20, "volume_rank", *order).select(
        "volume_rank", "corridor", "total_transfers", "total_volume_usd", "fraud_rate_pct", "corridor_risk"
    )


VIEWS = {
    "vw_fraud_summary": (vw_fraud_summary, "mart_fraud_prevention"),
    "vw_customer_health": (vw_customer_health, "mart_customer_360"),
    "vw_revenue_by_plan": (vw_revenue_by_plan, "mart_revenue_analytics"),
    "vw_corridor_top20": (vw_corridor_top20, "mart_corridor_analytics"),
}


def register_views(spark: SparkSession, tables, names: Iterable[str] = tuple(VIEWS)) -> None:
    """Make views queryable by name in ``spark.sql``; ``tables`` maps mart names to DataFrames."""
    for name in names:
        build, mart = VIEWS[name]
        build(tables[mart]).createOrReplaceTempView(name)


def _hundredths(column: str) -> str:
    """Sum of a column of two decimals in whole hundredths; as ``exact_sum``."""
    return f"SUM(CAST(FLOOR({column} * 100 + 0.5D) AS BIGINT))"


def _rounded_quotient(part: str, whole: str) -> str:
    """Whole numbers divided and rounded half away from zero; as ``half_away_div``."""
    return f"SIGN({part}) * ((ABS({part}) * 2 + {whole}) DIV NULLIF({whole} * 2, 0))"


def view_statements(database: str) -> dict[str, str]:
    """The views as queries over the marts of a database, for a catalog to keep."""
    health = "SUM(CAST(FLOOR(customer_health_score * 10 + 0.5D) AS BIGINT))"
    churn = ", ".join(
        f"COUNT_IF(churn_risk = '{level}') AS {name}"
        for level, name in zip(CHURN_LEVELS, ("high_churn_users", "moderate_churn_users", "stable_users"))
    )
    cents = _hundredths("total_revenue")
    return {
        "vw_fraud_summary": f"""SELECT fraud_risk_level, COUNT(1) AS users,
            {_hundredths("COALESCE(total_transfer_usd, 0D)")} / 100D AS exposure_usd
            FROM {database}.mart_fraud_prevention GROUP BY fraud_risk_level""",
        "vw_customer_health": f"""SELECT customer_segment, COUNT(1) AS users,
            {_rounded_quotient(health, "COUNT(customer_health_score)")} / 10D AS avg_health_score, {churn},
            {cents} / 100D AS total_revenue FROM {database}.mart_customer_360 GROUP BY customer_segment""",
        "vw_revenue_by_plan": f"""SELECT latest_subscription_plan, {cents} / 100D AS total_revenue,
            SUM(total_payments) AS total_transactions, {_rounded_quotient(cents, "SUM(total_payments)")} / 100D AS avg_spend
            FROM {database}.mart_revenue_analytics GROUP BY latest_subscription_plan""",
        "vw_corridor_top20": f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_volume_usd DESC, sender_country, receiver_country) AS BIGINT)
            AS volume_rank, corridor, total_transfers, total_volume_usd, fraud_rate_pct, corridor_risk
            FROM (SELECT * FROM {database}.mart_corridor_analytics
              ORDER BY total_volume_usd DESC, sender_country, receiver_country LIMIT 20)""",
    }


def create_views(spark: SparkSession, database: str, names: Iterable[str] = tuple(VIEWS)) -> None:
    """Create or replace the views in the catalog, over the marts that were written there: every session reads them by name,
    and they show the marts of the last run."""
    statements = view_statements(database)
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {statements[name]}")
