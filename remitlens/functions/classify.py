"""Business classifications as column expressions. Thresholds are the fixed values of the data contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.functions.numeric import half_away_div, round_half_up, scaled

# --- fixed values -------------------------------------------------------------------------------------------
SUCCESSFUL_PAYMENT_STATUSES = ("completed", "success", "paid")

DURATION_STEPS = ((30, "very_short"), (120, "short"), (600, "medium"))
QUALITY_STEPS = ((4.0, "excellent"), (3.0, "good"), (2.0, "fair"))
SIZE_STEPS = ((50, "micro"), (200, "small"), (500, "medium"), (1000, "large"))
SIZE_LABEL_STEPS = (
    (50, "Micro (<$50)"),
    (200, "Small (<$200)"),
    (500, "Medium (<$500)"),
    (1000, "Large (<$1K)"),
)
SIZE_LABEL_TOP = "Very Large (≥$1K)"

RISK_LEVELS = ("CRITICAL_RISK", "HIGH_RISK_FRAUD", "MEDIUM_RISK", "LOW_RISK", "SAFE")
SEVERITY_ORDER = ("CRITICAL_RISK", "HIGH_RISK_FRAUD", "MEDIUM_RISK", "LOW_RISK")
ELEVATED_RISK = ("CRITICAL_RISK", "HIGH_RISK_FRAUD")
SEGMENTS = ("VIP", "HIGH_VALUE", "ACTIVE", "REGULAR", "INACTIVE")
CHURN_LEVELS = ("HIGH_CHURN_RISK", "MODERATE_CHURN_RISK", "STABLE")
CORRIDOR_RISKS = ("HIGH_RISK_CORRIDOR", "MONITOR_CORRIDOR", "SAFE_CORRIDOR")

# Right-open buckets of fraud signals; the label of a bucket names its upper edge.
SIGNAL_STEPS = ((1, "1"), (2, "2"), (3, "3"), (5, "4-5"), (8, "6-8"))
SIGNAL_TOP = "9+"
SIGNAL_BUCKETS = tuple(label for _, label in SIGNAL_STEPS) + (SIGNAL_TOP,)

SLA_TARGETS = {
    "connection_success_rate_pct": 98.0,
    "avg_mos_score": 4.0,
    "sla_quality_met_pct": 95.0,
    "avg_delivery_rate_pct": 95.0,
}
# ------------------------------------------------------------------------------------------------------------


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def first_match(rules: list[tuple[Column, object]], default: object) -> Column:
    """The label of the first rule that holds."""
    head, *tail = rules
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), tail, F.when(head[0], head[1]))
    return chain.otherwise(default)


def below_steps(value: Column, steps, top: str) -> Column:
    """The label of the first step whose upper edge exceeds the value."""
    return first_match([(value < edge, F.lit(label)) for edge, label in steps], F.lit(top))


def duration_bucket(seconds: Column) -> Column:
    known = zero_if_null(seconds)
    return F.when(known == 0, F.lit("no_connection")).otherwise(below_steps(known, DURATION_STEPS, "long"))


def quality_tier(score: Column) -> Column:
    """Tier of the unrounded score."""
    known = zero_if_null(score)
    return first_match([(known >= floor, F.lit(label)) for floor, label in QUALITY_STEPS], F.lit("poor"))


def size_tier(amount: Column) -> Column:
    """Tier of the unrounded amount."""
    return below_steps(zero_if_null(amount), SIZE_STEPS, "very_large")


def size_label(amount: Column) -> Column:
    return below_steps(amount, SIZE_LABEL_STEPS, SIZE_LABEL_TOP)


def payment_succeeded(clean_status: Column) -> Column:
    return F.coalesce(clean_status.isin(*SUCCESSFUL_PAYMENT_STATUSES), F.lit(False))


def fraud_signals(fraud_transfers: Column, fraud_tickets: Column) -> Column:
    return zero_if_null(fraud_transfers) + zero_if_null(fraud_tickets)


def fraud_risk_level(
    *,
    fraud_transfers: Column,
    fraud_tickets: Column,
    failure_pct: Column,
    transfer_usd: Column,
    very_large: Column,
    tickets: Column,
) -> Column:
    flagged = zero_if_null(fraud_transfers) > 0
    reported = zero_if_null(fraud_tickets) > 0
    failure = zero_if_null(failure_pct)
    heavy = (failure > 30.0) | (zero_if_null(transfer_usd) > 900) | (zero_if_null(very_large) > 2)
    uneasy = (failure > 15.0) | (zero_if_null(tickets) > 5)
    critical, high, medium, low, safe = (F.lit(level) for level in RISK_LEVELS)
    return first_match(
        [(flagged & reported, critical), (flagged | reported, high), (heavy, medium), (uneasy, low)], safe
    )


def health_score(*, quality: Column, satisfaction: Column, failure_pct: Column, risk_level: Column) -> Column:
    """0-100: call quality, satisfaction, reliability and trust, 25 points each."""
    quality_points = F.coalesce(quality, F.lit(3.0)) / 5.0 * 25
    satisfaction_points = F.coalesce(satisfaction, F.lit(3.0)) / 5.0 * 25
    failure = zero_if_null(failure_pct)
    reliability = first_match(
        [(failure < 10, F.lit(25.0)), (failure < 25, F.lit(15.0)), (failure < 50, F.lit(5.0))], F.lit(0.0)
    )
    trust = first_match(
        [(risk_level.isin("SAFE", "LOW_RISK"), F.lit(25.0)), (risk_level == "MEDIUM_RISK", F.lit(10.0))],
        F.lit(0.0),
    )
    return round_half_up(quality_points + satisfaction_points + reliability + trust, 1)


def customer_segment(*, revenue: Column, calls: Column, transfers: Column, transfer_usd: Column) -> Column:
    vip, high_value, active, regular, inactive = (F.lit(name) for name in SEGMENTS)
    paid, called, sent = zero_if_null(revenue), zero_if_null(calls), zero_if_null(transfers)
    return first_match(
        [
            ((paid > 500) & (called > 50) & (sent > 20), vip),
            ((paid > 200) | (zero_if_null(transfer_usd) > 500), high_value),
            ((called > 30) | (sent > 10), active),
            ((called > 0) | (sent > 0), regular),
        ],
        inactive,
    )


def churn_risk(*, tickets: Column, satisfaction: Column, failure_pct: Column) -> Column:
    high, moderate, stable = (F.lit(name) for name in CHURN_LEVELS)
    opened = zero_if_null(tickets)
    unhappy = F.coalesce(satisfaction, F.lit(5.0)) < 3.0
    return first_match(
        [
            ((opened > 3) & unhappy & (zero_if_null(failure_pct) > 20), high),
            ((opened > 2) | unhappy, moderate),
        ],
        stable,
    )


def corridor_risk(fraud_count: Column, fraud_pct: Column) -> Column:
    high, monitor, safe = (F.lit(name) for name in CORRIDOR_RISKS)
    return first_match([((fraud_count > 5) | (fraud_pct > 10), high), (fraud_count > 0, monitor)], safe)


def unit_value(total: Column, units: Column) -> Column:
    """Money per unit, rounded to cents; 0 when there are no units."""
    per_unit = half_away_div(scaled(total, 2), units) / F.lit(100.0)
    return F.when(zero_if_null(units) > 0, per_unit).otherwise(F.lit(0.0))


def lifetime_value(revenue: Column, transfer_usd: Column) -> Column:
    """Revenue plus 5 % of the transfer volume, rounded to cents."""
    per_ten_thousand = scaled(revenue, 2) * 100 + scaled(F.coalesce(transfer_usd, F.lit(0.0)), 2) * 5
    return half_away_div(per_ten_thousand, F.lit(100)) / F.lit(100.0)


def signal_bucket(signals: Column) -> Column:
    return below_steps(signals, SIGNAL_STEPS, SIGNAL_TOP)


def severity_rank(risk_level: Column) -> Column:
    """0 for the most severe tier; 99 for tiers outside the severity list."""
    return first_match(
        [(risk_level == level, F.lit(rank)) for rank, level in enumerate(SEVERITY_ORDER)], F.lit(99)
    )


def is_fraud_label(risk_level: Column) -> Column:
    return F.coalesce(risk_level.isin(*ELEVATED_RISK), F.lit(False)).cast("int")
