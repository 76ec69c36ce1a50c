"""The raw bindings and the models as common table expressions, for DuckDB on the supplied tables.

Marts are written over a spine of all users with left joins, not the way the DataFrame code builds them.
"""

from __future__ import annotations


def rounded(expression: str, places: int) -> str:
    """Half-up rounding on six decimals, the rounding rule of all results."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(24,6)), {places}) AS DOUBLE)"


def rate(part: str, whole: str, places: int = 2) -> str:
    return rounded(f"({part}) * CAST(100 AS DOUBLE) / NULLIF({whole}, 0)", places)


def where(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def trimmed(column: str, case: str) -> str:
    return f"{case}(REGEXP_REPLACE({column}, '^\\s+|\\s+$', '', 'g'))"


RISK_ORDER = (
    "CASE fraud_risk_level WHEN 'CRITICAL_RISK' THEN 0 WHEN 'HIGH_RISK_FRAUD' THEN 1 "
    "WHEN 'MEDIUM_RISK' THEN 2 WHEN 'LOW_RISK' THEN 3 ELSE 99 END"
)

RAW = {
    "raw_cdrs": """
        SELECT 'CALL-' || event_id AS call_id, 'USR-' || user_id AS user_id,
          CASE WHEN event_id % 97 = 0 THEN NULL
               WHEN event_type = 'error' THEN CAST(FLOOR(value) AS BIGINT) % 31
               ELSE CAST(FLOOR(value * 20) AS BIGINT) END AS duration_seconds,
          CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_type <> 'error' END AS connection_success,
          CASE WHEN event_id % 83 = 0 THEN NULL
               WHEN event_type = 'error' THEN 0.5E0 + CAST((event_id * 37) % 1501 AS DOUBLE) / 1000
               ELSE 1.0E0 + CAST((event_id * 37) % 4001 AS DOUBLE) / 1000 END AS call_quality_score,
          CASE WHEN event_id % 79 = 0 THEN NULL
               WHEN event_type = 'error' THEN CAST((event_id * 17) % 5001 AS DOUBLE) / 100
               ELSE 70.0E0 + CAST((event_id * 13) % 3000 AS DOUBLE) / 100 END AS delivery_rate_percent,
          CAST(ts AS TIMESTAMP) AS "timestamp"
        FROM events WHERE NOT (user_id % 10 = 5 AND event_id % 4 <> 0)""",
    "raw_transfers": """
        SELECT 'TRF-' || l.l_orderkey || '-' || l.l_linenumber AS transfer_id,
          'USR-' || o.o_custkey AS user_id,
          ' ' || LOWER(home.n_name) AS sender_country,
          CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE LOWER(away.n_name) || ' ' END AS receiver_country,
          CASE WHEN l.l_orderkey % 103 = 0 THEN NULL ELSE l.l_extendedprice / 50 END AS transfer_amount_usd,
          CASE WHEN l.l_orderkey % 107 = 0 THEN NULL
               ELSE (l.l_returnflag = 'R' AND l.l_discount > 0.045E0 AND o.o_custkey % 4 = 1)
          END AS is_fraud_flag
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
          JOIN nation home ON c.c_nationkey = home.n_nationkey
          JOIN nation away ON s.s_nationkey = away.n_nationkey
        WHERE o.o_custkey % 5 <> 0""",
    "raw_payments": """
        SELECT 'TXN-' || o.o_orderkey AS transaction_id, 'USR-' || o.o_custkey AS user_id,
          ' ' || c.c_mktsegment || ' ' AS subscription_plan,
          CASE WHEN o.o_orderkey % 109 = 0 THEN NULL ELSE o.o_totalprice / 5000 END AS payment_amount,
          CASE o.o_orderstatus WHEN 'F' THEN 'Success '
               WHEN 'O' THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'PAID' ELSE 'pending' END
               ELSE CASE WHEN o.o_orderkey % 3 = 0 THEN 'refunded' ELSE 'Failed' END END AS payment_status
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_custkey % 7 <> 0""",
    "raw_tickets": """
        SELECT 'ZD-' || o_orderkey AS ticket_id, 'USR-' || o_custkey AS user_id,
          CAST(o_orderdate AS TIMESTAMP) AS created_at,
          CAST(o_orderdate + INTERVAL '1' MINUTE * CAST((o_orderkey * 7) % 5000 AS INT) AS TIMESTAMP) AS updated_at,
          CASE WHEN o_custkey % 6 = 1 AND o_orderkey % 4 = 0 THEN ' Fraud_Alert'
               WHEN o_orderkey % 3 = 0 THEN 'PAYMENT_FAILURE ' WHEN o_orderkey % 3 = 1 THEN 'call_drop'
               ELSE 'Topup_Delay' END AS issue_category,
          SUBSTRING(o_orderpriority, 3) AS priority,
          CASE o_orderkey % 4 WHEN 0 THEN 'Open' WHEN 1 THEN 'pending ' WHEN 2 THEN 'SOLVED'
               ELSE 'closed' END AS ticket_status,
          CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 1 + o_orderkey % 5 END AS satisfaction_score,
          'AB-' || o_orderkey AS _airbyte_ab_id,
          TIMESTAMP '2024-01-01 00:00:00' AS _airbyte_emitted_at,
          TIMESTAMP '2024-01-01 00:00:00' AS _airbyte_normalized_at
        FROM orders WHERE o_orderkey % 10 < 3""",
}

STAGING = {
    "stg_tickets": f"""
        SELECT ticket_id, user_id, created_at, updated_at,
          {trimmed("issue_category", "LOWER")} AS issue_category,
          {trimmed("priority", "LOWER")} AS priority,
          {trimmed("ticket_status", "LOWER")} AS ticket_status,
          satisfaction_score, _airbyte_ab_id, _airbyte_emitted_at,
          DATE_SUB('hour', created_at, updated_at) AS resolution_hours
        FROM raw_tickets WHERE ticket_id IS NOT NULL AND user_id IS NOT NULL""",
    "stg_cdrs": f"""
        SELECT call_id, user_id, IFNULL(duration_seconds, 0) AS duration_seconds,
          IFNULL(connection_success, FALSE) AS connection_success,
          {rounded("IFNULL(call_quality_score, 0)", 2)} AS call_quality_score,
          {rounded("IFNULL(delivery_rate_percent, 0)", 2)} AS delivery_rate_percent,
          "timestamp" AS event_timestamp,
          CASE WHEN IFNULL(duration_seconds, 0) >= 600 THEN 'long' WHEN duration_seconds >= 120 THEN 'medium'
               WHEN duration_seconds >= 30 THEN 'short' WHEN IFNULL(duration_seconds, 0) <> 0 THEN 'very_short'
               ELSE 'no_connection' END AS call_duration_bucket,
          CASE WHEN call_quality_score IS NULL OR call_quality_score < 2 THEN 'poor'
               WHEN call_quality_score < 3 THEN 'fair' WHEN call_quality_score < 4 THEN 'good'
               ELSE 'excellent' END AS quality_tier
        FROM raw_cdrs WHERE call_id IS NOT NULL AND user_id IS NOT NULL""",
    "stg_transfers": f"""
        SELECT transfer_id, user_id, sender_country, receiver_country,
          {rounded("amount", 2)} AS transfer_amount_usd, is_fraud_flag,
          CASE WHEN amount >= 1000 THEN 'very_large' WHEN amount >= 500 THEN 'large' WHEN amount >= 200 THEN 'medium'
               WHEN amount >= 50 THEN 'small' ELSE 'micro' END AS transfer_size_tier,
          sender_country || ' -> ' || receiver_country AS corridor
        FROM (SELECT transfer_id, user_id, {trimmed("sender_country", "UPPER")} AS sender_country,
                {trimmed("receiver_country", "UPPER")} AS receiver_country,
                IFNULL(transfer_amount_usd, 0) AS amount, IFNULL(is_fraud_flag, FALSE) AS is_fraud_flag
              FROM raw_transfers WHERE transfer_id IS NOT NULL AND user_id IS NOT NULL)""",
    "stg_payments": f"""
        SELECT transaction_id, user_id, subscription_plan, {rounded("amount", 2)} AS payment_amount, payment_status,
          IFNULL(payment_status IN ('completed', 'success', 'paid'), FALSE) AS is_payment_successful
        FROM (SELECT transaction_id, user_id, {trimmed("subscription_plan", "LOWER")} AS subscription_plan,
                {trimmed("payment_status", "LOWER")} AS payment_status, IFNULL(payment_amount, 0) AS amount
              FROM raw_payments WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL)""",
}


def _flags(column: str, pairs: list[tuple[str, str]]) -> str:
    return ",\n          ".join(f"{where(f"{column} = '{value}'")} AS {name}" for value, name in pairs)


FACTS = {
    "fct_telecom_calls": f"""
        SELECT user_id, COUNT(*) AS total_calls, {where("NOT connection_success")} AS failed_calls,
          {where("connection_success")} AS successful_calls,
          {rounded("AVG(duration_seconds)", 2)} AS avg_duration_seconds,
          CAST(MAX(duration_seconds) AS DOUBLE) AS max_duration_seconds,
          CAST(SUM(duration_seconds) AS DOUBLE) AS total_duration_seconds,
          {rounded("AVG(call_quality_score)", 2)} AS avg_quality_score,
          MIN(call_quality_score) AS min_quality_score,
          {rounded("AVG(delivery_rate_percent)", 2)} AS avg_delivery_rate_pct,
          {rate(where("NOT connection_success"), "COUNT(*)")} AS call_failure_rate_pct,
          {where("call_duration_bucket = 'no_connection'")} AS no_connection_calls,
          {where("quality_tier = 'poor'")} AS poor_quality_calls,
          {where("quality_tier = 'excellent'")} AS excellent_quality_calls
        FROM stg_cdrs GROUP BY user_id""",
    "fct_financial_transfers": f"""
        SELECT user_id, COUNT(*) AS total_transfers, {rounded("SUM(transfer_amount_usd)", 2)} AS total_transfer_usd,
          {rounded("AVG(transfer_amount_usd)", 2)} AS avg_transfer_usd, MAX(transfer_amount_usd) AS max_transfer_usd,
          MIN(transfer_amount_usd) AS min_transfer_usd, {where("is_fraud_flag")} AS fraud_transfers,
          {rate(where("is_fraud_flag"), "COUNT(*)")} AS fraud_rate_pct,
          COUNT(DISTINCT sender_country) AS distinct_sender_countries,
          COUNT(DISTINCT receiver_country) AS distinct_receiver_countries,
          COUNT(DISTINCT corridor) AS distinct_corridors,
          {where("transfer_size_tier = 'very_large'")} AS very_large_transfers,
          {where("transfer_size_tier = 'micro'")} AS micro_transfers
        FROM stg_transfers GROUP BY user_id""",
    "fct_support_tickets": f"""
        SELECT user_id, COUNT(*) AS total_tickets,
          {_flags("issue_category", [("fraud_alert", "fraud_tickets"), ("payment_failure", "payment_failure_tickets"),
                                     ("call_drop", "call_drop_tickets"), ("topup_delay", "topup_delay_tickets")])},
          {rounded("AVG(satisfaction_score)", 2)} AS avg_satisfaction_score,
          {rounded("AVG(resolution_hours)", 2)} AS avg_resolution_hours,
          {_flags("ticket_status", [(s, s + "_tickets") for s in ("open", "pending", "solved", "closed")])},
          {_flags("priority", [("urgent", "urgent_tickets"), ("high", "high_priority_tickets")])}
        FROM stg_tickets GROUP BY user_id""",
    "fct_payments": f"""
        SELECT user_id, COUNT(*) AS total_payments, {rounded("SUM(payment_amount)", 2)} AS total_payment_amount,
          {rounded("AVG(payment_amount)", 2)} AS avg_payment_amount,
          {where("is_payment_successful")} AS successful_payments,
          {where("NOT is_payment_successful")} AS failed_payments,
          {rate(where("NOT is_payment_successful"), "COUNT(*)")} AS payment_failure_rate_pct,
          COUNT(DISTINCT subscription_plan) AS distinct_plans, MAX(subscription_plan) AS latest_subscription_plan
        FROM stg_payments GROUP BY user_id""",
}

MARTS = {
    "mart_fraud_prevention": """
        SELECT user_id, total_calls, failed_calls, call_failure_rate_pct, avg_quality_score, avg_delivery_rate_pct,
          poor_quality_calls, total_transfers, total_transfer_usd, avg_transfer_usd, fraud_transfers, fraud_rate_pct,
          very_large_transfers, total_tickets AS support_tickets, fraud_tickets, avg_satisfaction_score,
          IFNULL(fraud_transfers, 0) + IFNULL(fraud_tickets, 0) AS total_fraud_signals,
          CASE WHEN fraud_transfers > 0 AND fraud_tickets > 0 THEN 'CRITICAL_RISK'
               WHEN IFNULL(fraud_transfers, 0) + IFNULL(fraud_tickets, 0) > 0 THEN 'HIGH_RISK_FRAUD'
               WHEN call_failure_rate_pct > 30 OR total_transfer_usd > 900 OR very_large_transfers > 2
                 THEN 'MEDIUM_RISK'
               WHEN call_failure_rate_pct > 15 OR total_tickets > 5 THEN 'LOW_RISK'
               ELSE 'SAFE' END AS fraud_risk_level
        FROM (SELECT user_id FROM fct_telecom_calls UNION SELECT user_id FROM fct_financial_transfers
              UNION SELECT user_id FROM fct_support_tickets) AS everyone
          LEFT JOIN fct_telecom_calls USING (user_id) LEFT JOIN fct_financial_transfers USING (user_id)
          LEFT JOIN fct_support_tickets USING (user_id)""",
    "mart_customer_360": f"""
        SELECT user_id, IFNULL(c.total_calls, 0) AS total_calls, IFNULL(t.total_transfers, 0) AS total_transfers,
          IFNULL(p.total_payments, 0) AS total_payments, IFNULL(k.total_tickets, 0) AS total_support_tickets,
          IFNULL(c.total_calls, 0) + IFNULL(t.total_transfers, 0) + IFNULL(p.total_payments, 0)
            AS total_activity_events,
          IFNULL(p.total_payment_amount, 0) AS total_revenue,
          IFNULL(t.total_transfer_usd, 0) AS total_transfer_volume_usd, p.latest_subscription_plan,
          IFNULL(c.avg_quality_score, 0) AS call_quality_score,
          IFNULL(c.call_failure_rate_pct, 0) AS call_failure_rate_pct,
          IFNULL(k.avg_satisfaction_score, 0) AS support_satisfaction_score,
          IFNULL(k.avg_resolution_hours, 0) AS avg_ticket_resolution_hours, f.fraud_risk_level,
          IFNULL(p.payment_failure_rate_pct, 0) AS payment_failure_rate_pct,
          {rounded('''IFNULL(c.avg_quality_score, 3) * 5 + IFNULL(k.avg_satisfaction_score, 3) * 5
            + CASE WHEN c.call_failure_rate_pct >= 50 THEN 0 WHEN c.call_failure_rate_pct >= 25 THEN 5
                   WHEN c.call_failure_rate_pct >= 10 THEN 15 ELSE 25 END
            + CASE f.fraud_risk_level WHEN 'SAFE' THEN 25 WHEN 'LOW_RISK' THEN 25 WHEN 'MEDIUM_RISK' THEN 10
                   ELSE 0 END''', 1)} AS customer_health_score,
          CASE WHEN p.total_payment_amount > 500 AND c.total_calls > 50 AND t.total_transfers > 20 THEN 'VIP'
               WHEN p.total_payment_amount > 200 OR t.total_transfer_usd > 500 THEN 'HIGH_VALUE'
               WHEN c.total_calls > 30 OR t.total_transfers > 10 THEN 'ACTIVE'
               WHEN c.total_calls > 0 OR t.total_transfers > 0 THEN 'REGULAR' ELSE 'INACTIVE' END
            AS customer_segment,
          CASE WHEN k.total_tickets > 3 AND k.avg_satisfaction_score < 3 AND c.call_failure_rate_pct > 20
                 THEN 'HIGH_CHURN_RISK'
               WHEN k.total_tickets > 2 OR k.avg_satisfaction_score < 3 THEN 'MODERATE_CHURN_RISK'
               ELSE 'STABLE' END AS churn_risk
        FROM (SELECT user_id FROM fct_telecom_calls UNION SELECT user_id FROM fct_financial_transfers
              UNION SELECT user_id FROM fct_support_tickets UNION SELECT user_id FROM fct_payments) AS everyone
          LEFT JOIN fct_telecom_calls c USING (user_id) LEFT JOIN fct_financial_transfers t USING (user_id)
          LEFT JOIN fct_support_tickets k USING (user_id) LEFT JOIN fct_payments p USING (user_id)
          LEFT JOIN mart_fraud_prevention f USING (user_id)""",
    "mart_revenue_analytics": f"""
        SELECT user_id, latest_subscription_plan, total_payments, total_payment_amount AS total_revenue,
          avg_payment_amount AS avg_revenue_per_txn, successful_payments, failed_payments, payment_failure_rate_pct,
          IFNULL(total_transfer_usd, 0) AS transfer_volume_usd,
          IFNULL({rounded("total_payment_amount / NULLIF(total_calls, 0)", 2)}, 0) AS revenue_per_call,
          IFNULL({rounded("total_payment_amount / NULLIF(total_transfers, 0)", 2)}, 0) AS revenue_per_transfer,
          {rounded("total_payment_amount + IFNULL(total_transfer_usd, 0) * 0.05E0", 2)} AS estimated_ltv
        FROM fct_payments LEFT JOIN fct_telecom_calls USING (user_id)
          LEFT JOIN fct_financial_transfers USING (user_id)""",
    "mart_network_quality": f"""
        SELECT 'OVERALL' AS dimension, COUNT(*) AS total_calls, {where("connection_success")} AS connected_calls,
          {where("NOT connection_success")} AS dropped_calls,
          {rate(where("connection_success"), "COUNT(*)")} AS connection_success_rate_pct,
          {rounded("AVG(duration_seconds)", 2)} AS avg_call_duration_sec,
          {rounded("AVG(call_quality_score)", 2)} AS avg_mos_score,
          {rounded("AVG(delivery_rate_percent)", 2)} AS avg_delivery_rate_pct,
          {_flags("quality_tier", [(q, q + "_calls") for q in ("excellent", "good", "fair", "poor")])},
          {rate(where("call_quality_score >= 3"), "COUNT(*)")} AS sla_quality_met_pct,
          {rate(where("connection_success"), "COUNT(*)")} AS sla_connection_met_pct,
          {_flags("call_duration_bucket",
                  [(d, "calls_" + d) for d in ("no_connection", "very_short", "short", "medium", "long")])}
        FROM stg_cdrs""",
    "mart_corridor_analytics": f"""
        SELECT *, CASE WHEN fraud_count > 5 OR fraud_rate_pct > 10 THEN 'HIGH_RISK_CORRIDOR'
                       WHEN fraud_count = 0 THEN 'SAFE_CORRIDOR' ELSE 'MONITOR_CORRIDOR' END AS corridor_risk
        FROM (SELECT sender_country, receiver_country, corridor, COUNT(*) AS total_transfers,
                COUNT(DISTINCT user_id) AS unique_senders,
                {rounded("SUM(transfer_amount_usd)", 2)} AS total_volume_usd,
                {rounded("AVG(transfer_amount_usd)", 2)} AS avg_transfer_usd,
                MAX(transfer_amount_usd) AS max_transfer_usd, {where("is_fraud_flag")} AS fraud_count,
                {rate(where("is_fraud_flag"), "COUNT(*)")} AS fraud_rate_pct,
                {_flags("transfer_size_tier",
                        [(s, s + "_transfers") for s in ("micro", "small", "medium", "large", "very_large")])}
              FROM stg_transfers GROUP BY sender_country, receiver_country, corridor)""",
}

LAYERS = {**RAW, **STAGING, **FACTS, **MARTS}


def statement(body: str) -> str:
    """Put the layers a query mentions, directly or through other layers, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in LAYERS.items():
            if name in text and name not in needed:
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = ",\n      ".join(f"{name} AS ({LAYERS[name]})" for name in LAYERS if name in needed)
    if not ctes:
        return body
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
