"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Every query is built and run in full each time, from the scans to a sink that discards the rows. Seconds are the
median of the timed runs after one warm-up run. ``fraud_facts_union`` and ``fraud_facts_full_outer`` compare the two ways to
align the facts of the fraud mart.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from remitlens.plans.marts import CALL_COLUMNS, TRANSFER_COLUMNS, one_row_per_user  # noqa: E402
from remitlens.plans.models import Warehouse  # noqa: E402
from remitlens.registry import QUERIES  # noqa: E402
from remitlens.session import build_session  # noqa: E402

HEADLINE = (
    "stg_cdrs",
    "stg_transfers",
    "fct_telecom_calls",
    "fct_financial_transfers",
    "fct_support_tickets",
    "fct_payments",
    "mart_fraud_prevention",
    "mart_customer_360",
    "mart_revenue_analytics",
    "mart_network_quality",
    "mart_corridor_analytics",
    "tier_exposure",
    "fraud_ledger",
    "vw_customer_health",
    "vw_corridor_top20",
    "executive_kpis",
    "health_box_by_churn",
    "dedup_transfers",
    "dq_orphan_users",
    "stream_fct_calls",
)
RUNS = 3
# Measured too, but not part of the total: timed runs of each, after one warm-up run (none if that is their only run).
EXTRA = {"stream_dedup": 2, "dq_row_counts": 2, "ml_metrics": 1}
TICKET_COLUMNS = ("total_tickets", "fraud_tickets", "avg_satisfaction_score")


def _facts(spark, sf_dir):
    tables = Warehouse.over(spark, sf_dir)
    return [
        (tables["fct_telecom_calls"], CALL_COLUMNS),
        (tables["fct_financial_transfers"], TRANSFER_COLUMNS),
        (tables["fct_support_tickets"], TICKET_COLUMNS),
    ]


def union_form(spark, sf_dir):
    return one_row_per_user(_facts(spark, sf_dir))


def full_outer_form(spark, sf_dir):
    first, *others = [fact.select("user_id", *columns) for fact, columns in _facts(spark, sf_dir)]
    for other in others:
        first = first.join(other, "user_id", "full")
    return first


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: QUERIES[name] for name in (*HEADLINE, *EXTRA)}
    chosen |= {"fraud_facts_union": union_form, "fraud_facts_full_outer": full_outer_form}
    seconds: dict[str, float] = {}
    for name, query in chosen.items():
        runs = []
        timed = EXTRA.get(name, RUNS)
        for _ in range(timed + (timed > 1)):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
