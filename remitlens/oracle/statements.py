"""Expected results as SQL, one statement per registered query that SQL can express."""

from __future__ import annotations

from remitlens.oracle.layers import LAYERS, RAW, RISK_ORDER, rate, rounded, statement, where

FRAUD_FRAME = """(SELECT user_id, fraud_risk_level, IFNULL(total_calls, 0) AS total_calls,
    IFNULL(failed_calls, 0) AS failed_calls, IFNULL(call_failure_rate_pct, 0) AS call_failure_rate_pct,
    IFNULL(total_transfers, 0) AS total_transfers, IFNULL(total_transfer_usd, 0) AS total_transfer_usd,
    IFNULL(fraud_transfers, 0) AS fraud_transfers, IFNULL(support_tickets, 0) AS support_tickets,
    IFNULL(fraud_tickets, 0) AS fraud_tickets, total_fraud_signals FROM mart_fraud_prevention)"""
CUSTOMER_FRAME = """SELECT user_id, total_calls, total_transfers, total_payments, total_revenue,
    total_transfer_volume_usd, customer_health_score, customer_segment, churn_risk FROM mart_customer_360"""
AMOUNT = "IFNULL(transfer_amount_usd, 0)"
ELEVATED = "fraud_risk_level IN ('CRITICAL_RISK', 'HIGH_RISK_FRAUD')"
BY_VOLUME = "total_volume_usd DESC, sender_country ASC NULLS FIRST, receiver_country ASC NULLS FIRST"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def fixed_text(expression: str, places: int) -> str:
    return f"CAST(CAST(ROUND(CAST({expression} AS DECIMAL(24,6)), {places}) AS DECIMAL(24,{places})) AS VARCHAR)"


def currency(value: str) -> str:
    dollars = f"CAST(ROUND(CAST({value} AS DECIMAL(24,6)), 0) AS BIGINT)"
    return (
        f"CASE WHEN {value} >= 1000000 THEN '$' || {fixed_text(f'{value} / 1000000', 2)} || 'M' "
        f"WHEN {value} >= 100000 THEN '$' || {fixed_text(f'{value} / 1000', 0)} || 'K' "
        f"WHEN {value} >= 1000 THEN '$' || {fixed_text(f'{value} / 1000', 1)} || 'K' "
        f"ELSE '$' || FORMAT('{{:,}}', {dollars}) END"
    )


def percent_text(value: str) -> str:
    return f"{fixed_text(value, 1)} || '%'"


def totals(amount: str) -> str:
    return rounded(f"SUM({amount})", 2)


def histogram(source: str, column: str, bins: int) -> str:
    return f"""WITH v AS (SELECT CAST({column} AS DOUBLE) AS v FROM {source} WHERE {column} IS NOT NULL),
      b AS (SELECT MIN(v) AS low, MAX(v) AS high FROM v),
      n AS (SELECT low, high, CASE WHEN high = low THEN 0
              ELSE LEAST(CAST(FLOOR((v - low) / (high - low) * {bins}) AS BIGINT), {bins - 1}) END AS bin FROM v, b)
      SELECT bin, {rounded(f"low + bin * ((high - low) / {bins})", 4)} AS bin_from,
        {rounded(f"low + (bin + 1) * ((high - low) / {bins})", 4)} AS bin_to, COUNT(*) AS rows
      FROM n GROUP BY bin, low, high"""


def first_per_key(source: str, key: str, rest: list[str]) -> str:
    order = ", ".join(f'"{name}" ASC NULLS FIRST' for name in rest)
    return f"""SELECT * EXCLUDE (position) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order})
      AS position FROM ({source})) WHERE position = 1"""


QUARTILES = (("q1", "0.25E0"), ("median", "0.5E0"), ("q3", "0.75E0"))


def between_neighbours(share: str, name: str) -> str:
    """The value of the sorted list ``xs`` at (rows - 1) * share, between its two neighbours."""
    place = f"((rows - 1) * {share})"
    low, high = (f"xs[CAST({f}{place} AS BIGINT) + 1]" for f in ("FLOOR", "CEIL"))
    return f"{low} * (1 - ({place} - FLOOR{place})) + {high} * ({place} - FLOOR{place}) AS {name}"


def quotient(part: str, whole: str) -> str:
    """0 where it is undefined."""
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) ELSE 0 END"


# Rules of a feature and a bound, and the cells of a confusion matrix (actual, predicted).
RULES = (
    ("Call Failures", "call_failure_rate_pct", 30),
    ("Transfer Volume", "total_transfer_usd", 900),
    ("Support Tickets", "support_tickets", 5),
    ("Fraud Signals", "total_fraud_signals", 1),
)
CELLS = (("true_safe", 0, 0), ("false_fraud", 0, 1), ("false_safe", 1, 0), ("true_fraud", 1, 1))


def rule_rows(rule: str, feature: str, bound: int) -> str:
    return f"""SELECT '{rule}' AS rule, CAST({ELEVATED} AS INTEGER) AS label, CAST(IFNULL({feature}, 0) AS DOUBLE) AS score,
        CAST(IFNULL({feature}, 0) > {bound} AS INTEGER) AS prediction FROM mart_fraud_prevention"""


# The rank sum of the frauds, with the mean rank of equal scores, taken twice to stay whole.
AREAS_OF = f"""told AS ({{rows}}),
    ranks AS (SELECT *, 2 * RANK() OVER (PARTITION BY rule ORDER BY score) + COUNT(*) OVER (PARTITION BY rule, score) - 1 AS twice FROM told),
    sums AS (SELECT rule, CAST(COALESCE(SUM(twice) FILTER (WHERE label = 1), 0) AS BIGINT) AS twice,
      COUNT(*) FILTER (WHERE label = 1) AS p, COUNT(*) FILTER (WHERE label = 0) AS n FROM ranks GROUP BY rule),
    areas AS (SELECT rule, {quotient("twice - p * (p + 1)", "2 * p * n")} AS auc FROM sums)"""


def count_row(name: str, source: str | None = None) -> str:
    return f"SELECT '{name}' AS table_name, COUNT(*) AS rows FROM {source or name}"


def union_all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# Column types as Spark names them.
TICKET_TYPES = {
    "ticket_id": "string",
    "user_id": "string",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "issue_category": "string",
    "priority": "string",
    "ticket_status": "string",
    "satisfaction_score": "bigint",
    "_airbyte_ab_id": "string",
    "_airbyte_emitted_at": "timestamp",
    "_airbyte_normalized_at": "timestamp",
}
REQUIRED_FIELDS = [
    ("raw_tickets", "ticket_id"),
    ("raw_tickets", "user_id"),
    ("raw_cdrs", "call_id"),
    ("raw_cdrs", "user_id"),
    ("raw_transfers", "transfer_id"),
    ("raw_transfers", "user_id"),
    ("raw_payments", "transaction_id"),
    ("raw_payments", "user_id"),
]
# The columns of the marts, without the time of the last refresh.
MART_COLUMNS = {
    "mart_fraud_prevention": (
        "user_id total_calls failed_calls call_failure_rate_pct avg_quality_score avg_delivery_rate_pct poor_quality_calls "
        "total_transfers total_transfer_usd avg_transfer_usd fraud_transfers fraud_rate_pct very_large_transfers "
        "support_tickets fraud_tickets avg_satisfaction_score total_fraud_signals fraud_risk_level"
    ).split(),
    "mart_customer_360": (
        "user_id total_calls total_transfers total_payments total_support_tickets total_activity_events total_revenue "
        "total_transfer_volume_usd latest_subscription_plan call_quality_score call_failure_rate_pct "
        "support_satisfaction_score avg_ticket_resolution_hours fraud_risk_level payment_failure_rate_pct "
        "customer_health_score customer_segment churn_risk"
    ).split(),
    "mart_revenue_analytics": (
        "user_id latest_subscription_plan total_payments total_revenue avg_revenue_per_txn successful_payments "
        "failed_payments payment_failure_rate_pct transfer_volume_usd revenue_per_call revenue_per_transfer estimated_ltv"
    ).split(),
    "mart_network_quality": (
        "dimension total_calls connected_calls dropped_calls connection_success_rate_pct avg_call_duration_sec "
        "avg_mos_score avg_delivery_rate_pct excellent_calls good_calls fair_calls poor_calls sla_quality_met_pct "
        "sla_connection_met_pct calls_no_connection calls_very_short calls_short calls_medium calls_long"
    ).split(),
    "mart_corridor_analytics": (
        "sender_country receiver_country corridor total_transfers unique_senders total_volume_usd avg_transfer_usd "
        "max_transfer_usd fraud_count fraud_rate_pct micro_transfers small_transfers medium_transfers large_transfers "
        "very_large_transfers corridor_risk"
    ).split(),
}
RAW_WIDTHS = {"raw_tickets": 11, "raw_cdrs": 7, "raw_transfers": 6, "raw_payments": 5}
RAW_COLUMNS = {
    "raw_tickets": list(TICKET_TYPES),
    "raw_cdrs": [
        "call_id",
        "user_id",
        "duration_seconds",
        "connection_success",
        "call_quality_score",
        "delivery_rate_percent",
        "timestamp",
    ],
    "raw_transfers": [
        "transfer_id",
        "user_id",
        "sender_country",
        "receiver_country",
        "transfer_amount_usd",
        "is_fraud_flag",
    ],
    "raw_payments": ["transaction_id", "user_id", "subscription_plan", "payment_amount", "payment_status"],
}
LAYER_NAMES = {"raw": "RAW", "stg": "STAGING", "fct": "FACT", "mart": "MART"}
MODEL_NAMES = [name for name in LAYERS if not name.startswith("raw_")]
ML_NUMBERS = (
    "total_calls failed_calls call_failure_rate_pct avg_quality_score avg_delivery_rate_pct poor_quality_calls "
    "total_transfers total_transfer_usd avg_transfer_usd fraud_transfers fraud_rate_pct very_large_transfers "
    "support_tickets fraud_tickets avg_satisfaction_score total_fraud_signals"
).split()
ML_TABLE = f"""SELECT user_id, {", ".join(f"CAST(IFNULL({n}, 0) AS DOUBLE) AS {n}" for n in ML_NUMBERS)},
    CAST({ELEVATED} AS INTEGER) AS is_fraud FROM mart_fraud_prevention"""
REDELIVERED_CALLS = "SELECT * FROM raw_cdrs UNION ALL SELECT * FROM raw_cdrs"


def layer_of(name: str) -> str:
    return LAYER_NAMES[name.split("_")[0]]


def null_share(source: str) -> str:
    columns = RAW_COLUMNS[source] if source in RAW_COLUMNS else MART_COLUMNS[source]
    nulls = " + ".join(f'COUNT(*) FILTER (WHERE "{c}" IS NULL)' for c in columns)
    width = len(columns) if source in MART_COLUMNS else RAW_WIDTHS[source]
    return f"""SELECT '{source}' AS source, COUNT(*) AS rows, CAST({width} AS BIGINT) AS columns,
      {rate(nulls, f"(COUNT(*) * {width})")} AS null_pct FROM {source}"""


def _bodies() -> dict[str, str]:
    found = {name: f"SELECT * FROM {name}" for name in LAYERS if name not in RAW}

    # landing files and loads
    found |= {
        "src_json_array": "SELECT * FROM raw_tickets",
        "src_json_microbatches": "SELECT * FROM raw_cdrs",
        "src_csv_payments": "SELECT * FROM raw_payments",
        "src_optional": "SELECT * FROM raw_payments",
        "coerce_numeric": """SELECT transaction_id, user_id,
            CASE WHEN CAST(SUBSTR(transaction_id, 5) AS BIGINT) % 13 = 0 THEN CAST(0 AS DOUBLE)
                 ELSE IFNULL(payment_amount, 0) END AS payment_amount FROM raw_payments""",
        "dq_required_fields": union_all(
            [
                f"""SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS rows,
                {where(f"{c} IS NULL")} AS null_rows,
                CASE WHEN COUNT({c}) = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}"""
                for t, c in REQUIRED_FIELDS
            ]
        ),
        "meta_columns": union_all(
            [
                f"""SELECT 'raw_tickets' AS table_name, '{c}' AS column_name, '{kind}' AS data_type,
                COUNT("{c}") AS filled_rows FROM raw_tickets"""
                for c, kind in TICKET_TYPES.items()
            ]
        ),
        "dq_row_counts": union_all(
            [
                f"""SELECT '{layer_of(name)}' AS layer, table_name, rows,
                CASE WHEN rows > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM ({count_row(name)})"""
                for name in LAYERS
            ]
            + ["SELECT 'MART' AS layer, 'mart_not_built' AS table_name, CAST(NULL AS BIGINT) AS rows, 'MISSING' AS status"]
        ),
        "load_csv_raw": "SELECT * FROM raw_payments",
        "load_json_raw": "SELECT * FROM raw_cdrs UNION ALL SELECT * FROM raw_cdrs",
        "dq_landing_files": union_all(
            [
                f"""SELECT '{prefix}' AS prefix, COUNT(*) AS records,
                CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, COUNT(*) > 0 AS has_files FROM {table}"""
                for prefix, table in (
                    ("stream/cdrs", "raw_cdrs"),
                    ("stream/transfers", "raw_transfers"),
                    ("batch/payments", "raw_payments"),
                )
            ]
        ),
        "sink_overwrite": "SELECT * FROM fct_telecom_calls",
        "sink_append": "SELECT * FROM raw_tickets UNION ALL SELECT * FROM raw_tickets",
        "sink_append_loads": "SELECT * FROM raw_tickets",
        "sink_csv": f"""SELECT user_id, fraud_risk_level, total_fraud_signals, total_transfer_usd, fraud_transfers,
            call_failure_rate_pct, failed_calls, fraud_tickets FROM {FRAUD_FRAME}
            ORDER BY total_fraud_signals DESC, user_id LIMIT 30""",
        "ingest_audit_columns": """SELECT ticket_id, user_id, created_at, updated_at, issue_category, priority,
            ticket_status, satisfaction_score, CAST(36 AS BIGINT) AS record_id_length, TRUE AS same_load_time
            FROM raw_tickets""",
    }

    # filters
    found |= {
        "filter_risk_tiers": f"SELECT * FROM {FRAUD_FRAME} WHERE {ELEVATED}",
        "filter_segment": f"{CUSTOMER_FRAME} WHERE customer_segment = 'HIGH_VALUE'",
        "filter_plan": "SELECT * FROM stg_payments WHERE subscription_plan = 'building'",
        "filter_churn": f"{CUSTOMER_FRAME} WHERE churn_risk IN ('HIGH_CHURN_RISK', 'MODERATE_CHURN_RISK')",
        "filter_corridor_risk": "SELECT * FROM mart_corridor_analytics WHERE corridor_risk = 'HIGH_RISK_CORRIDOR'",
        "filter_options": union_all(
            [
                f"SELECT DISTINCT '{c}' AS filter_name, {c} AS option FROM {t} WHERE {c} IS NOT NULL"
                for t, c in (
                    ("mart_fraud_prevention", "fraud_risk_level"),
                    ("mart_customer_360", "customer_segment"),
                    ("stg_payments", "subscription_plan"),
                )
            ]
        ),
        "search_all_columns": "SELECT * FROM raw_tickets WHERE "
        + " OR ".join(
            f"IFNULL(REGEXP_MATCHES(CAST({c} AS VARCHAR), 'fraud|urgent', 'i'), FALSE)" for c in TICKET_TYPES
        ),
        "sample_tickets": """SELECT ticket_id, user_id, issue_category, _airbyte_ab_id, _airbyte_emitted_at
            FROM raw_tickets ORDER BY ticket_id LIMIT 3""",
        "risk_profile": f"""SELECT user_id, fraud_risk_level, call_failure_rate_pct, total_transfer_usd,
            total_fraud_signals, fraud_transfers, fraud_tickets, support_tickets FROM {FRAUD_FRAME}""",
        "fmt_currency": f"""SELECT user_id, total_transfer_usd, {currency("total_transfer_usd")} AS transfer_label,
            {percent_text("call_failure_rate_pct")} AS failure_label FROM {FRAUD_FRAME}""",
    }

    # fraud reports
    signals = rounded("AVG(total_fraud_signals)", 2)
    exposure = totals("total_transfer_usd")
    found |= {
        "risk_distribution": f"""SELECT fraud_risk_level, user_count,
            {rate("user_count", "SUM(user_count) OVER ()", 1)} AS share_pct
            FROM (SELECT fraud_risk_level, COUNT(*) AS user_count FROM mart_fraud_prevention GROUP BY 1)""",
        "tier_exposure": f"""SELECT fraud_risk_level, COUNT(*) AS users, {exposure} AS exposure_usd,
            {signals} AS avg_signals, {whole("SUM(failed_calls)")} AS failed_calls,
            {whole("SUM(fraud_transfers)")} AS fraud_transfers, {whole(f"ANY_VALUE({RISK_ORDER})")} AS severity
            FROM {FRAUD_FRAME} GROUP BY fraud_risk_level""",
        "signal_heatmap": f"""SELECT fraud_risk_level,
            {", ".join(f'{where(f"total_fraud_signals BETWEEN {a} AND {b}")} AS "{label}"' for a, b, label in
                       [(0, 0, "1"), (1, 1, "2"), (2, 2, "3"), (3, 4, "4-5"), (5, 7, "6-8"), (8, 10**12, "9+")])}
            FROM mart_fraud_prevention WHERE fraud_risk_level <> 'SAFE' GROUP BY fraud_risk_level""",
        "elevated_risk_pct": f"""SELECT COUNT(*) AS users, {where("fraud_risk_level = 'CRITICAL_RISK'")} AS critical,
            {where("fraud_risk_level = 'HIGH_RISK_FRAUD'")} AS high,
            {rate(where(ELEVATED), "COUNT(*)")} AS elevated_pct FROM mart_fraud_prevention""",
        "fraud_kpis": f"""SELECT COUNT(*) AS users, {where("fraud_risk_level = 'CRITICAL_RISK'")} AS critical,
            {rate(where("fraud_risk_level = 'CRITICAL_RISK'"), "COUNT(*)")} AS critical_pct,
            {where("fraud_risk_level = 'HIGH_RISK_FRAUD'")} AS high,
            {rate(where("fraud_risk_level = 'HIGH_RISK_FRAUD'"), "COUNT(*)")} AS high_pct,
            {signals} AS avg_signals, {exposure} AS exposure_usd FROM {FRAUD_FRAME}""",
        "fraud_ledger": f"""SELECT user_id, fraud_risk_level, total_fraud_signals, total_transfer_usd,
            fraud_transfers, call_failure_rate_pct, failed_calls, fraud_tickets,
            {currency("total_transfer_usd")} AS transfer_label,
            {percent_text("call_failure_rate_pct")} AS failure_label
            FROM {FRAUD_FRAME} ORDER BY total_fraud_signals DESC, user_id LIMIT 30""",
        "fraud_ledger_by_exposure": f"""SELECT * FROM {FRAUD_FRAME}
            ORDER BY total_fraud_signals DESC, total_transfer_usd DESC, user_id""",
        "executive_kpis": f"""SELECT (SELECT COUNT(*) FROM mart_fraud_prevention) AS users,
            (SELECT COUNT(*) FROM mart_fraud_prevention WHERE {ELEVATED}) AS high_risk_users,
            COUNT(*) AS calls, {rate(where("connection_success"), "COUNT(*)")} AS connection_pct,
            (SELECT {totals(AMOUNT)} FROM raw_transfers) AS transfer_volume_usd,
            (SELECT {totals("IFNULL(payment_amount, 0)")} FROM raw_payments) AS payment_revenue_usd FROM raw_cdrs""",
    }

    found["executive_kpis_from_marts"] = f"""SELECT (SELECT COUNT(*) FROM mart_fraud_prevention) AS users,
        (SELECT COUNT(*) FROM mart_fraud_prevention WHERE {ELEVATED}) AS high_risk_users,
        total_calls AS calls, connection_success_rate_pct AS connection_pct,
        (SELECT {totals("transfer_amount_usd")} FROM stg_transfers) AS transfer_volume_usd,
        (SELECT {totals("payment_amount")} FROM stg_payments) AS revenue_usd FROM mart_network_quality"""

    # customers, network
    health = rounded("AVG(customer_health_score)", 1)
    call_means = f"""{rounded("AVG(IFNULL(call_quality_score, 0))", 2)} AS avg_quality,
            {rounded("AVG(IFNULL(duration_seconds, 0))", 2)} AS avg_duration"""
    found |= {
        "segment_summary": f"""SELECT customer_segment, COUNT(*) AS users, {health} AS avg_health_score
            FROM mart_customer_360 GROUP BY customer_segment""",
        "segment_churn_matrix": f"""SELECT customer_segment, churn_risk, COUNT(*) AS users,
            {health} AS avg_health_score FROM mart_customer_360 GROUP BY customer_segment, churn_risk""",
        "churn_distribution": "SELECT churn_risk, COUNT(*) AS user_count FROM mart_customer_360 GROUP BY churn_risk",
        "revenue_per_segment": f"""SELECT customer_segment, {rounded("AVG(total_revenue)", 2)} AS avg_revenue
            FROM mart_customer_360 GROUP BY customer_segment""",
        "ticket_breakdown": union_all(
            [
                f"""SELECT '{c}' AS dimension, {c} AS value, COUNT(*) AS tickets FROM raw_tickets
                WHERE {c} IS NOT NULL GROUP BY {c}"""
                for c in ("issue_category", "ticket_status")
            ]
        ),
        "cdr_stats": f"""SELECT COUNT(*) AS total_calls, {where("connection_success")} AS connected,
            {rate(where("connection_success"), "COUNT(*)")} AS conn_rate, {call_means},
            {rounded("AVG(IFNULL(delivery_rate_percent, 0))", 2)} AS avg_delivery FROM raw_cdrs""",
        "cdr_top_users": f"""SELECT user_id, COUNT(*) AS calls, {call_means} FROM raw_cdrs GROUP BY user_id
            ORDER BY calls DESC, user_id LIMIT 15""",
        "sla_scorecard": union_all(
            [
                f"""SELECT '{metric}' AS metric, {metric} AS value, CAST({target} AS DOUBLE) AS target,
                {rounded(f"{metric} - {target}", 2)} AS gap, {metric} >= {target} AS is_met
                FROM mart_network_quality"""
                for metric, target in (
                    ("connection_success_rate_pct", 98),
                    ("avg_mos_score", 4),
                    ("sla_quality_met_pct", 95),
                    ("avg_delivery_rate_pct", 95),
                )
            ]
        ),
        "mos_breakdown": union_all(
            [
                f"SELECT '{label}' AS quality, COUNT(*) AS calls FROM stg_cdrs WHERE quality_tier = '{tier}'"
                for tier, label in (
                    ("excellent", "Excellent (≥4.0)"),
                    ("good", "Good (3.0-3.9)"),
                    ("fair", "Fair (2.0-2.9)"),
                    ("poor", "Poor (<2.0)"),
                )
            ]
        ),
        "duration_breakdown": union_all(
            [
                f"SELECT '{label}' AS bucket, COUNT(*) AS calls FROM stg_cdrs WHERE call_duration_bucket = '{bucket}'"
                for bucket, label in (
                    ("no_connection", "No Conn"),
                    ("very_short", "Very Short"),
                    ("short", "Short"),
                    ("medium", "Medium"),
                    ("long", "Long"),
                )
            ]
        ),
        "hist_quality": histogram("(SELECT IFNULL(call_quality_score, 0) AS x FROM raw_cdrs)", "x", 30),
        "hist_duration": histogram("(SELECT duration_seconds AS x FROM raw_cdrs WHERE duration_seconds > 0)", "x", 30),
        "hist_health": histogram("mart_customer_360", "customer_health_score", 20),
        "hist_payment": histogram("(SELECT IFNULL(payment_amount, 0) AS x FROM raw_payments)", "x", 30),
        "health_box_by_churn": f"""SELECT churn_risk, rows, lowest, {rounded("q1", 4)} AS q1,
            {rounded("median", 4)} AS median, {rounded("q3", 4)} AS q3, highest,
            {rounded("q1 - 1.5E0 * (q3 - q1)", 4)} AS lower_fence,
            {rounded("q3 + 1.5E0 * (q3 - q1)", 4)} AS upper_fence
            FROM (SELECT churn_risk, COUNT(*) AS rows, MIN(customer_health_score) AS lowest,
              MAX(customer_health_score) AS highest, QUANTILE_CONT(customer_health_score, 0.25) AS q1,
              QUANTILE_CONT(customer_health_score, 0.5) AS median, QUANTILE_CONT(customer_health_score, 0.75) AS q3
              FROM mart_customer_360 GROUP BY churn_risk)""",
        "transfer_box_by_sender": f"""SELECT sender_country, rows, lowest, q1, median, q3, highest,
            q1 - (q3 - q1) * 1.5E0 AS lower_fence, q3 + (q3 - q1) * 1.5E0 AS upper_fence
            FROM (SELECT *, {", ".join(between_neighbours(share, name) for name, share in QUARTILES)}
              FROM (SELECT sender_country, COUNT(*) AS rows, MIN(x) AS lowest, MAX(x) AS highest, LIST_SORT(LIST(x)) AS xs
                FROM (SELECT sender_country, IFNULL(transfer_amount_usd, 0) AS x FROM raw_transfers) GROUP BY sender_country))""",
        "profile_nulls": union_all([null_share(name) for name in (*RAW, *MART_COLUMNS)]),
        "distinct_users": union_all(
            [f"SELECT '{name}' AS source, COUNT(DISTINCT user_id) AS users FROM {name}" for name in RAW]
        ),
    }

    # revenue
    found |= {
        "payment_kpis": f"""SELECT COUNT(*) AS payments, {totals("payment_amount")} AS total_revenue,
            {rounded("AVG(payment_amount)", 2)} AS avg_payment,
            {rate(where("payment_status = 'success'"), "COUNT(*)")} AS success_pct,
            {rate(where("payment_status = 'failed'"), "COUNT(*)")} AS failure_pct FROM stg_payments""",
        "plan_revenue": f"""SELECT subscription_plan, {totals("payment_amount")} AS revenue, COUNT(*) AS txns
            FROM stg_payments GROUP BY subscription_plan""",
        "payment_status_counts": """SELECT payment_status, COUNT(*) AS payments FROM stg_payments
            GROUP BY payment_status""",
        "failure_rate_by_plan": f"""SELECT subscription_plan,
            {rate(where("payment_status = 'failed'"), "COUNT(*)")} AS failure_rate
            FROM stg_payments GROUP BY subscription_plan""",
        "revenue_by_plan": f"""SELECT latest_subscription_plan, COUNT(*) AS users,
            {totals("total_revenue")} AS total_revenue, {rounded("AVG(estimated_ltv)", 2)} AS avg_ltv
            FROM mart_revenue_analytics GROUP BY latest_subscription_plan""",
        "chart_revenue_by_plan": f"""SELECT p.latest_subscription_plan, COUNT(r.user_id) AS users,
            {totals("r.total_revenue")} AS total_revenue, {rounded("AVG(r.estimated_ltv)", 2)} AS avg_ltv
            FROM mart_revenue_analytics r JOIN fct_payments p ON r.user_id = p.user_id
            GROUP BY p.latest_subscription_plan""",
    }

    # transfers and corridors
    found |= {
        "raw_fraud_signals": f"""SELECT COUNT(*) AS transfers, {where("is_fraud_flag")} AS flagged,
            {rate(where("is_fraud_flag"), "COUNT(*)")} AS fraud_rate_pct FROM raw_transfers""",
        "transfer_kpis": f"""SELECT COUNT(*) AS transfers, {totals(AMOUNT)} AS total_volume,
            {rounded(f"AVG({AMOUNT})", 2)} AS avg_transfer, MAX({AMOUNT}) AS max_transfer FROM raw_transfers""",
        "transfer_size_labels": f"""SELECT CASE WHEN {AMOUNT} >= 1000 THEN 'Very Large (≥$1K)'
            WHEN {AMOUNT} >= 500 THEN 'Large (<$1K)' WHEN {AMOUNT} >= 200 THEN 'Medium (<$500)'
            WHEN {AMOUNT} >= 50 THEN 'Small (<$200)' ELSE 'Micro (<$50)' END AS size_label, COUNT(*) AS transfers
            FROM raw_transfers GROUP BY 1""",
        "sender_top12": f"""SELECT sender_country, {totals(AMOUNT)} AS volume FROM raw_transfers
            GROUP BY sender_country ORDER BY volume DESC, sender_country LIMIT 12""",
        "raw_corridor_top15": f"""SELECT sender_country || ' → ' || receiver_country AS corridor,
            {totals(AMOUNT)} AS volume, COUNT(*) AS transfers FROM raw_transfers
            WHERE receiver_country IS NOT NULL GROUP BY 1 ORDER BY volume DESC, corridor LIMIT 15""",
        "corridor_topk": f"""SELECT corridor, corridor_risk, total_transfers, total_volume_usd, fraud_rate_pct
            FROM mart_corridor_analytics ORDER BY {BY_VOLUME} LIMIT 20""",
        "corridor_risk_register": """SELECT corridor, corridor_risk, total_transfers, total_volume_usd,
            avg_transfer_usd, fraud_count, fraud_rate_pct FROM mart_corridor_analytics""",
    }

    # views
    found |= {
        "vw_fraud_summary": f"""SELECT fraud_risk_level, COUNT(*) AS users, {exposure} AS exposure_usd
            FROM {FRAUD_FRAME} GROUP BY fraud_risk_level""",
        "vw_customer_health": f"""SELECT customer_segment, COUNT(*) AS users, {health} AS avg_health_score,
            {where("churn_risk = 'HIGH_CHURN_RISK'")} AS high_churn_users,
            {where("churn_risk = 'MODERATE_CHURN_RISK'")} AS moderate_churn_users,
            {where("churn_risk = 'STABLE'")} AS stable_users, {totals("total_revenue")} AS total_revenue
            FROM mart_customer_360 GROUP BY customer_segment""",
        "vw_revenue_by_plan": f"""SELECT latest_subscription_plan, {totals("total_revenue")} AS total_revenue,
            {whole("SUM(total_payments)")} AS total_transactions,
            {rounded("SUM(total_revenue) / NULLIF(SUM(total_payments), 0)", 2)} AS avg_spend
            FROM mart_revenue_analytics GROUP BY latest_subscription_plan""",
        "vw_corridor_top20": f"""SELECT ROW_NUMBER() OVER (ORDER BY {BY_VOLUME}) AS volume_rank, corridor,
            total_transfers, total_volume_usd, fraud_rate_pct, corridor_risk FROM mart_corridor_analytics
            ORDER BY {BY_VOLUME} LIMIT 20""",
    }

    # deduplication, quality, streams
    found |= {
        "dedup_transfers": first_per_key(
            "SELECT * FROM raw_transfers",
            "transfer_id",
            ["user_id", "sender_country", "receiver_country", "transfer_amount_usd", "is_fraud_flag"],
        ),
        "dedup_cdrs": first_per_key(REDELIVERED_CALLS, "call_id", RAW_COLUMNS["raw_cdrs"][1:]),
        "distinct_user_ids": "SELECT DISTINCT user_id FROM raw_tickets",
        "dq_min_rows": union_all(
            [
                f"""SELECT table_name, rows, CAST({minimum} AS BIGINT) AS minimum,
                CASE WHEN rows >= {minimum} THEN 'PASS' ELSE 'FAIL' END AS status FROM ({count_row(name)})"""
                for name, minimum in (("raw_cdrs", 2000), ("raw_transfers", 1000), ("raw_payments", 1000))
            ]
        ),
        "dq_duplicate_keys": union_all(
            [
                f"""SELECT '{t}' AS table_name, {k} AS key_value, COUNT(*) AS copies FROM {t}
                GROUP BY {k} HAVING COUNT(*) > 1"""
                for t, k in (("mart_fraud_prevention", "user_id"), ("raw_transfers", "transfer_id"))
            ]
        ),
        "dq_coverage": """SELECT COUNT(DISTINCT user_id) AS total_users, COUNT(total_calls) AS with_calls,
            COUNT(total_transfers) AS with_transfers, COUNT(support_tickets) AS with_tickets
            FROM mart_fraud_prevention""",
        "dq_orphan_users": union_all(
            [
                f"""SELECT '{t}' AS table_name, user_id FROM
                (SELECT user_id FROM {t} EXCEPT SELECT user_id FROM raw_tickets)"""
                for t in ("raw_cdrs", "raw_transfers", "raw_payments")
            ]
        ),
        "dq_expected_columns": union_all(
            [
                f"""SELECT '{t}' AS table_name, COUNT(*) AS rows, CAST({RAW_WIDTHS[t]} AS BIGINT) AS expected_columns,
                '' AS missing_columns, 'PASS' AS status FROM {t}"""
                for t in ("raw_cdrs", "raw_transfers", "raw_payments")
            ]
        ),
        "dq_audit_present": union_all(
            [
                f"""SELECT 'raw_tickets' AS table_name, '{c}' AS column_name, COUNT(*) AS rows,
                {where(f"{c} IS NULL")} AS null_rows, 'PASS' AS status FROM raw_tickets"""
                for c in ("_airbyte_ab_id", "_airbyte_emitted_at", "_airbyte_normalized_at")
            ]
        ),
        "model_run_summary": union_all(
            [
                f"""SELECT CAST({i} AS BIGINT) AS position, '{layer_of(name)}' AS layer, '{name}' AS model,
                COUNT(*) AS rows, 'PASS' AS status FROM {name}"""
                for i, name in enumerate(MODEL_NAMES, 1)
            ]
        ),
        "stream_landing": """SELECT 'CDR' AS stream, call_id AS record_id, user_id,
              CAST(duration_seconds AS DOUBLE) AS measure FROM raw_cdrs
            UNION ALL SELECT 'TRANSFER', transfer_id, user_id, transfer_amount_usd FROM raw_transfers""",
        "stream_foreachbatch": "SELECT * FROM raw_cdrs",
        "stream_dedup": "SELECT * FROM raw_cdrs",
        "stream_dedup_late": "SELECT * FROM raw_cdrs",
        "stream_staging": "SELECT * FROM stg_cdrs",
        "stream_fct_calls": "SELECT * FROM fct_telecom_calls",
        "stream_pull": "SELECT * FROM raw_cdrs",
        "stream_fct_transfers": "SELECT * FROM fct_financial_transfers",
    }

    # machine learning inputs
    bucket = "CAST('0x' || SUBSTR(MD5(user_id || ':42'), 1, 8) AS BIGINT) % 100"
    found |= {
        "ml_features": ML_TABLE,
        "ml_label_balance": f"""SELECT COUNT(*) AS users, {where(ELEVATED)} AS fraud_users,
            {where(f"NOT ({ELEVATED})")} AS safe_users, {rate(where(ELEVATED), "COUNT(*)", 1)} AS fraud_rate_pct
            FROM mart_fraud_prevention""",
        "ml_split": f"""SELECT user_id, CAST({ELEVATED} AS INTEGER) AS is_fraud, {bucket} < 70 AS is_training
            FROM mart_fraud_prevention""",
        "ml_class_weights": f"""SELECT is_fraud, COUNT(*) AS rows,
            CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / CAST(2 * COUNT(*) AS DOUBLE) AS class_weight
            FROM (SELECT CAST({ELEVATED} AS INTEGER) AS is_fraud FROM mart_fraud_prevention WHERE {bucket} < 70)
            GROUP BY is_fraud""",
        "ml_confusion": f"""SELECT CAST({ELEVATED} AS INTEGER) AS is_fraud, COUNT(*) AS rows FROM mart_fraud_prevention
            WHERE {bucket} >= 70 GROUP BY 1""",
        "ml_persist": f"SELECT user_id, TRUE AS same_prediction FROM mart_fraud_prevention WHERE {bucket} >= 70",
        "ml_feature_importance": union_all(
            [f"SELECT '{name}' AS feature, TRUE AS is_share, TRUE AS sums_to_one" for name in ML_NUMBERS]
        ),
    }
    found |= {
        "ml_split_exact": f"""SELECT user_id, is_fraud, ROW_NUMBER() OVER (PARTITION BY is_fraud ORDER BY digest)
              <= (7 * COUNT(*) OVER (PARTITION BY is_fraud) + 5) // 10 AS is_training
            FROM (SELECT user_id, CAST({ELEVATED} AS INTEGER) AS is_fraud, SUBSTR(MD5(user_id || ':42'), 1, 13) AS digest
              FROM mart_fraud_prevention)""",
        "ml_rule_figures": f"""WITH {AREAS_OF.format(rows=union_all([rule_rows(*rule) for rule in RULES]))},
            c AS (SELECT rule, {", ".join(f"{where(f'label = {a} AND prediction = {p}')} AS {name}" for name, a, p in CELLS)}
              FROM told GROUP BY rule),
            f AS (SELECT *, {quotient("true_fraud + true_safe", "true_fraud + true_safe + false_fraud + false_safe")} AS accuracy,
              {quotient("true_fraud", "true_fraud + false_fraud")} AS "precision",
              {quotient("true_fraud", "true_fraud + false_safe")} AS recall,
              {quotient("2 * true_fraud", "2 * true_fraud + false_fraud + false_safe")} AS f1 FROM c)
            SELECT f.rule, true_safe, false_fraud, false_safe, true_fraud, accuracy, "precision", recall, f1, auc,
              f.rule = FIRST_VALUE(f.rule) OVER (ORDER BY f1 DESC, position) AS is_best
            FROM f JOIN areas ON f.rule = areas.rule
            JOIN ({union_all([f"SELECT '{rule}' AS rule, {i} AS position" for i, (rule, _, _) in enumerate(RULES)])}) o
              ON f.rule = o.rule""",
        "ml_feature_areas": f"""WITH {AREAS_OF.format(rows=union_all([rule_rows(n, n, 0) for n in ML_NUMBERS]))}
            SELECT rule AS feature, auc FROM areas""",
    }
    shown = (
        ("vw_fraud_summary", "fraud_risk_level", "exposure_usd"),
        ("vw_customer_health", "customer_segment", "avg_health_score"),
        ("vw_revenue_by_plan", "latest_subscription_plan", "avg_spend"),
        ("vw_corridor_top20", "corridor", "total_volume_usd"),
    )
    found["vw_lasting"] = union_all(
        [f"SELECT '{name}' AS view_name, {label} AS label, {figure} AS figure FROM ({found[name]})" for name, label, figure in shown]
    )
    checks = "TRUE AS in_range, TRUE AS best_has_top_f1, TRUE AS top_f1_reached"
    classifiers = ("Random Forest", "Gradient Boosting", "Logistic Regression")
    for name in ("ml_metrics", "ml_metrics_without_label_features"):
        found[name] = union_all([f"SELECT '{model}' AS model, {checks}" for model in classifiers])
    return found


def oracle_statements() -> dict[str, str]:
    return {name: statement(body) for name, body in _bodies().items()}
