"""Every operator, model, view, report, check, stream and classifier as a query on the supplied tables.

A query takes (spark, sf_dir) and returns a DataFrame. Queries that need files, tables, checkpoints or saved
models write them into a fresh folder under the shared location of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.ml import fraud
from remitlens.operators import filters, profiling, quality, ranking
from remitlens.operators.dedup import first_per_key
from remitlens.plans import reports, views
from remitlens.plans.models import MODELS, Warehouse
from remitlens.plans.runner import catalog_store, file_store, run_counted, run_models, run_summary
from remitlens.plans.staging import stg_cdrs
from remitlens.session import prepare, scratch_path, settle
from remitlens.sources import bindings, loads, readers, writers
from remitlens.sources.bindings import plain_timestamps
from remitlens.streaming import ingest, spool
from remitlens.streaming.landed import LandedKeys, land_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REFRESH_COLUMNS = ("mart_refreshed_at", "refreshed_at")


def _register(name: str, query: Query) -> None:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    QUERIES[name] = run


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        _register(name, function)
        return function

    return add


def on_tables(name: str, build: Callable[..., DataFrame], *tables: str) -> None:
    """Register a query that is a function of raw or model tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse.over(spark, sf_dir)
        return build(*[warehouse[table] for table in tables])

    _register(name, run)


# --- models, views and reports -------------------------------------------------------------------------------
for _model in MODELS:
    on_tables(_model, lambda df: plain_timestamps(df.drop(*REFRESH_COLUMNS)), _model)


def by_view_name(name: str) -> None:
    """A reporting view, registered and read by its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views.register_views(spark, Warehouse.over(spark, sf_dir), (name,))
        return spark.sql(f"SELECT * FROM {name}")

    _register(name, run)


for _view in views.VIEWS:
    by_view_name(_view)



@query("vw_lasting")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four views in the catalog, over written marts, read by a second session: a label and a figure of each row."""
    tables, database = Warehouse.over(spark, sf_dir), _new_namespace(spark, "views_db")
    run_models({name: tables[name] for name in schemas.RAW_TABLES}, catalog_store(database))
    views.create_views(spark, database)
    other = spark.newSession()
    prepare(other)
    shown = (
        ("vw_fraud_summary", "fraud_risk_level", "exposure_usd"),
        ("vw_customer_health", "customer_segment", "avg_health_score"),
        ("vw_revenue_by_plan", "latest_subscription_plan", "avg_spend"),
        ("vw_corridor_top20", "corridor", "total_volume_usd"),
    )
    return quality.stacked(
        [other.table(f"{database}.{name}").select(F.lit(name).alias("view_name"), F.col(label).alias("label"), F.col(figure).alias("figure"))
         for name, label, figure in shown]
    )


FRAUD, CUSTOMER, REVENUE = "mart_fraud_prevention", "mart_customer_360", "mart_revenue_analytics"
NETWORK, CORRIDOR = "mart_network_quality", "mart_corridor_analytics"

on_tables("risk_distribution", reports.risk_distribution, FRAUD)
on_tables("tier_exposure", reports.tier_exposure, FRAUD)
on_tables("signal_heatmap", reports.signal_heatmap, FRAUD)
on_tables("elevated_risk_pct", reports.elevated_risk_pct, FRAUD)
on_tables("fraud_kpis", reports.fraud_kpis, FRAUD)
on_tables("fraud_ledger", reports.fraud_ledger, FRAUD)
on_tables("fraud_ledger_by_exposure", reports.fraud_ledger_by_exposure, FRAUD)
on_tables("risk_profile", reports.risk_profile, FRAUD)
on_tables("fmt_currency", reports.money_labels, FRAUD)
on_tables("executive_kpis", reports.executive_kpis, FRAUD, "raw_cdrs", "raw_transfers", "raw_payments")
on_tables("executive_kpis_from_marts", reports.executive_kpis_from_marts, FRAUD, NETWORK, CORRIDOR, REVENUE)
on_tables("segment_summary", reports.segment_summary, CUSTOMER)
on_tables("segment_churn_matrix", reports.segment_churn_matrix, CUSTOMER)
on_tables("churn_distribution", reports.churn_distribution, CUSTOMER)
on_tables("revenue_per_segment", reports.revenue_per_segment, CUSTOMER)
on_tables("ticket_breakdown", reports.ticket_breakdown, "raw_tickets")
on_tables("cdr_stats", reports.cdr_stats, "raw_cdrs")
on_tables("cdr_top_users", reports.cdr_top_users, "raw_cdrs")
on_tables("sla_scorecard", reports.sla_scorecard, NETWORK)
on_tables("mos_breakdown", reports.mos_breakdown, NETWORK)
on_tables("duration_breakdown", reports.duration_breakdown, NETWORK)
on_tables("payment_kpis", reports.payment_kpis, "stg_payments")
on_tables("plan_revenue", reports.plan_revenue, "stg_payments")
on_tables("payment_status_counts", reports.payment_status_counts, "stg_payments")
on_tables("failure_rate_by_plan", reports.failure_rate_by_plan, "stg_payments")
on_tables("revenue_by_plan", reports.revenue_by_plan, REVENUE)
on_tables("chart_revenue_by_plan", reports.chart_revenue_by_plan, REVENUE, "fct_payments")
on_tables("raw_fraud_signals", reports.raw_fraud_signals, "raw_transfers")
on_tables("transfer_kpis", reports.transfer_kpis, "raw_transfers")
on_tables("transfer_size_labels", reports.transfer_size_labels, "raw_transfers")
on_tables("sender_top12", reports.sender_top, "raw_transfers")
on_tables("raw_corridor_top15", reports.raw_corridor_top, "raw_transfers")
on_tables("corridor_topk", reports.corridor_topk, CORRIDOR)
on_tables("corridor_risk_register", reports.corridor_risk_register, CORRIDOR)
on_tables(
    "hist_quality",
    lambda df: profiling.histogram(filters.coerce_numeric(df, ["call_quality_score"]), "call_quality_score", 30),
    "raw_cdrs",
)
on_tables(
    "hist_duration",
    lambda df: profiling.histogram(df.where(F.col("duration_seconds") > 0), "duration_seconds", 30),
    "raw_cdrs",
)
on_tables("hist_health", lambda df: profiling.histogram(df, "customer_health_score", 20), CUSTOMER)
on_tables(
    "hist_payment",
    lambda df: profiling.histogram(filters.coerce_numeric(df, ["payment_amount"]), "payment_amount", 30),
    "raw_payments",
)
on_tables(
    "health_box_by_churn",
    lambda df: profiling.box_statistics(df, "churn_risk", "customer_health_score"),
    CUSTOMER,
)


on_tables(
    "transfer_box_by_sender",
    lambda df: profiling.exact_box_statistics(filters.coerce_numeric(df, ["transfer_amount_usd"]), "sender_country", "transfer_amount_usd"),
    "raw_transfers",
)


@query("profile_nulls")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine sources of the data explorer; the time of the last refresh is no content of a mart."""
    tables = Warehouse.over(spark, sf_dir)
    names = (*schemas.RAW_TABLES, *schemas.MART_TABLES)
    return quality.stacked([profiling.null_profile(tables[name].drop(*REFRESH_COLUMNS), name) for name in names])


@query("distinct_users")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    return quality.stacked(
        [
            tables[name].agg(F.lit(name).alias("source"), F.count_distinct("user_id").alias("users"))
            for name in schemas.RAW_TABLES
        ]
    )


# --- filters -------------------------------------------------------------------------------------------------
on_tables(
    "filter_risk_tiers",
    lambda df: filters.keep_selected(
        reports.fraud_frame(df), "fraud_risk_level", ("CRITICAL_RISK", "HIGH_RISK_FRAUD")
    ),
    FRAUD,
)
on_tables(
    "filter_segment",
    lambda df: filters.keep_choice(reports.customer_frame(df), "customer_segment", "HIGH_VALUE"),
    CUSTOMER,
)
on_tables("filter_plan", lambda df: filters.keep_choice(df, "subscription_plan", "building"), "stg_payments")
on_tables(
    "filter_churn",
    lambda df: filters.keep_selected(
        reports.customer_frame(df), "churn_risk", ("HIGH_CHURN_RISK", "MODERATE_CHURN_RISK")
    ),
    CUSTOMER,
)
on_tables(
    "filter_corridor_risk",
    lambda df: filters.keep_selected(df.drop("refreshed_at"), "corridor_risk", ("HIGH_RISK_CORRIDOR",)),
    CORRIDOR,
)


@query("filter_options")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    lists = ((FRAUD, "fraud_risk_level"), (CUSTOMER, "customer_segment"), ("stg_payments", "subscription_plan"))
    options = [
        filters.distinct_options(tables[table], column).select(
            F.lit(column).alias("filter_name"), F.col(column).alias("option")
        )
        for table, column in lists
    ]
    return quality.stacked(options).orderBy("filter_name", "option")


on_tables(
    "search_all_columns",
    lambda df: filters.search_all_columns(plain_timestamps(df), "fraud|urgent"),
    "raw_tickets",
)
on_tables(
    "sample_tickets",
    lambda df: plain_timestamps(
        filters.preview(
            df.select("ticket_id", "user_id", "issue_category", "_airbyte_ab_id", "_airbyte_emitted_at"),
            "ticket_id",
            3,
        )
    ),
    "raw_tickets",
)
on_tables("distinct_user_ids", lambda df: filters.filter_options(df, "user_id"), "raw_tickets")


# --- landing files and loads ---------------------------------------------------------------------------------
@query("src_json_array")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ticket-documents")
    writers.land_json_arrays(Warehouse.over(spark, sf_dir)["raw_tickets"], path, records_per_array=10_000, one_array_per_file=True)
    return plain_timestamps(readers.read_json(spark, path, schemas.TICKETS, glob="*.txt"))


@query("src_json_microbatches")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "call-batches")
    writers.land_json_arrays(Warehouse.over(spark, sf_dir)["raw_cdrs"], path, records_per_array=100, one_array_per_file=False)
    return plain_timestamps(readers.read_json(spark, path, schemas.CDRS, multi_line=False, glob="*.txt"))


def _landed_payments(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "payments-csv")
    writers.export_csv(Warehouse.over(spark, sf_dir)["raw_payments"], path)
    return path


@query("src_csv_payments")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = readers.read_csv(spark, _landed_payments(spark, sf_dir), schemas.PAYMENTS)
    return readers.enforce_required(loaded, schemas.REQUIRED["raw_payments"])


def _new_namespace(spark: SparkSession, label: str) -> str:
    location = scratch_path(spark, label)
    namespace = location.rsplit("/", 1)[-1].replace("-", "_")
    writers.create_namespace(spark, namespace, location)
    return namespace


@query("load_csv_raw")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments from CSV files, loaded twice with truncation."""
    table = f"{_new_namespace(spark, 'load_csv')}.raw_payments"
    files = loads.read_files(spark, _landed_payments(spark, sf_dir), schemas.PAYMENTS, kind="csv")
    for _ in range(2):
        loads.load(files, table, schemas.REQUIRED["raw_payments"], loads.TRUNCATE)
    return spark.table(table)


@query("load_json_raw")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls from landed JSON files: a load with truncation, then one that appends."""
    table, path = f"{_new_namespace(spark, 'load_json')}.raw_cdrs", scratch_path(spark, "calls-json")
    Warehouse.over(spark, sf_dir)["raw_cdrs"].write.options(**readers.JSON_TIMES).json(path)
    files = loads.read_files(spark, path, schemas.CDRS, multi_line=False)
    for mode in (loads.TRUNCATE, loads.APPEND):
        loads.load(files, table, schemas.REQUIRED["raw_cdrs"], mode)
    return plain_timestamps(spark.table(table))


@query("src_optional")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An existing and a missing file: the missing one contributes an empty table of the same schema."""
    paths = (_landed_payments(spark, sf_dir), scratch_path(spark, "absent"))
    return quality.stacked(
        [
            readers.read_optional(
                spark, schemas.PAYMENTS, lambda path=path: readers.read_csv(spark, path, schemas.PAYMENTS)
            )
            for path in paths
        ]
    )


@query("coerce_numeric")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts landed as text, every thirteenth of them unreadable."""
    number = F.expr("substring(transaction_id, 5)").cast("bigint")
    text = F.when(number % 13 == 0, F.lit("n/a")).otherwise(F.col("payment_amount").cast("string"))
    landed = Warehouse.over(spark, sf_dir)["raw_payments"].select("transaction_id", "user_id", text.alias("payment_amount"))
    return filters.coerce_numeric(landed, ["payment_amount"])


@query("ingest_audit_columns")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = Warehouse.over(spark, sf_dir)["raw_tickets"].drop(*schemas.AUDIT_COLUMNS)
    audited = readers.with_audit_columns(source)
    return plain_timestamps(
        audited.select(
            *source.columns,
            F.length("_airbyte_ab_id").cast("bigint").alias("record_id_length"),
            (F.col("_airbyte_emitted_at") == F.col("_airbyte_normalized_at")).alias("same_load_time"),
        )
    )


@query("sink_overwrite")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace and a table in it, loaded twice: the second load replaces the first."""
    namespace = _new_namespace(spark, "facts_db")
    facts = Warehouse.over(spark, sf_dir)["fct_telecom_calls"]
    for _ in range(2):
        table = writers.replace_table(facts, f"{namespace}.fct_telecom_calls")
    return table


@query("sink_append")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tickets-appended")
    tickets = Warehouse.over(spark, sf_dir)["raw_tickets"]
    for _ in range(2):
        appended = writers.append_files(tickets, path)
    return plain_timestamps(appended)


@query("sink_append_loads")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, each delivered twice: every load's rows are there once."""
    table = f"{_new_namespace(spark, 'loads_db')}.raw_tickets"
    tickets = Warehouse.over(spark, sf_dir)["raw_tickets"]
    for load in ("even", "odd", "even", "odd"):
        wanted = F.crc32("ticket_id") % 2 == ("even", "odd").index(load)
        loaded = writers.append_load(tickets.where(wanted), table, load)
    return plain_timestamps(loaded.table.drop(writers.LOAD_ID))


@query("sink_csv")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported ledger, read back."""
    path = scratch_path(spark, "ledger-csv")
    ledger = reports.fraud_ledger(Warehouse.over(spark, sf_dir)[FRAUD]).select(*reports.LEDGER_COLUMNS)
    writers.export_csv(ledger, path, single_file=True)
    return readers.read_csv(spark, path, ledger.schema)


# --- data quality --------------------------------------------------------------------------------------------
@query("dq_required_fields")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    return quality.stacked(
        [quality.required_field_nulls(name, tables[name], schemas.REQUIRED[name]) for name in schemas.RAW_TABLES]
    )


@query("dq_audit_present")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = Warehouse.over(spark, sf_dir)["raw_tickets"]
    return quality.required_field_nulls("raw_tickets", tickets, schemas.AUDIT_COLUMNS)


on_tables("meta_columns", lambda df: quality.column_metadata("raw_tickets", df), "raw_tickets")


def _built_tables(spark: SparkSession, sf_dir: str):
    tables = Warehouse.over(spark, sf_dir)
    raw = {name: tables[name] for name in schemas.RAW_TABLES}
    return run_models(raw, file_store(scratch_path(spark, "warehouse")))


@query("dq_row_counts")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 17 tables, the models as a run wrote them into the catalog, and one that nobody wrote. Every table is counted by the job
    that reads or writes it anyhow."""
    tables, database = Warehouse.over(spark, sf_dir), _new_namespace(spark, "catalog")
    raw = {name: tables[name] for name in schemas.RAW_TABLES}
    _, runs, read = run_counted(raw, catalog_store(database))
    layers = {**schemas.LAYERS, "mart_not_built": "MART"}
    models = quality.catalog_tables(spark, database, [name for name in layers if name not in raw])
    written = {run.model: run.rows for run in runs if run.status == "PASS"}
    return quality.non_empty_check({**raw, **models}, layers, {**read, **written})


@query("model_run_summary")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(spark, _built_tables(spark, sf_dir)[1])


@query("dq_min_rows")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    minimum = {"raw_cdrs": 2000, "raw_transfers": 1000, "raw_payments": 1000}
    tables = Warehouse.over(spark, sf_dir)
    return quality.minimum_rows({name: tables[name] for name in minimum}, minimum)


@query("dq_duplicate_keys")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    keys = ((FRAUD, "user_id"), ("raw_transfers", "transfer_id"))
    return quality.stacked([quality.duplicate_keys(name, tables[name], key) for name, key in keys])


on_tables("dq_coverage", quality.domain_coverage, FRAUD)


@query("dq_orphan_users")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    children = ("raw_cdrs", "raw_transfers", "raw_payments")
    return quality.stacked(
        [quality.orphan_keys(name, tables[name], tables["raw_tickets"], "user_id") for name in children]
    )


@query("dq_expected_columns")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Warehouse.over(spark, sf_dir)
    return quality.stacked(
        [
            quality.expected_columns(name, tables[name], schemas.RAW_SCHEMAS[name].names)
            for name in ("raw_cdrs", "raw_transfers", "raw_payments")
        ]
    )


@query("dq_landing_files")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, root = Warehouse.over(spark, sf_dir), scratch_path(spark, "landing")
    parts = []
    for prefix, name in (("stream/cdrs", "raw_cdrs"), ("stream/transfers", "raw_transfers")):
        ingest.publish_messages(tables[name], f"{root}/{prefix}")
        parts.append(quality.landing_files(prefix, spark.read.text(f"{root}/{prefix}")))
    payments = f"{root}/batch/payments"
    writers.export_csv(tables["raw_payments"], payments)
    parts.append(quality.landing_files("batch/payments", readers.read_csv(spark, payments, schemas.PAYMENTS)))
    return quality.stacked(parts).withColumn("has_files", F.col("files") > 0).drop("files")


# --- deduplication -------------------------------------------------------------------------------------------
def _redelivered_calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All calls, and the fifth of them that is delivered again."""
    events = bindings.SourceTables(spark, sf_dir)["events"]
    again = events.where(F.col("event_id") % 5 == 0)
    return bindings.calls_from_events(events), bindings.calls_from_events(again)


on_tables("dedup_transfers", lambda df: first_per_key(df, "transfer_id"), "raw_transfers")


@query("dedup_cdrs")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, again = _redelivered_calls(spark, sf_dir)
    return plain_timestamps(first_per_key(first.unionByName(again), "call_id"))


# --- streams -------------------------------------------------------------------------------------------------
@query("stream_landing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two message streams landed as JSON files, one query each, then read back from the landing folders."""
    tables, root = Warehouse.over(spark, sf_dir), scratch_path(spark, "stream-landing")
    landed = []
    for label, name, key, measure in (
        ("CDR", "raw_cdrs", "call_id", "duration_seconds"),
        ("TRANSFER", "raw_transfers", "transfer_id", "transfer_amount_usd"),
    ):
        topic, out = f"{root}/topic/{name}", f"{root}/landed/{name}"
        ingest.publish_messages(tables[name], topic)
        stream = ingest.consume_topic(spark, topic, schemas.RAW_SCHEMAS[name], required=schemas.REQUIRED[name])
        ingest.drain(ingest.land_json(stream, out, f"{root}/checkpoint/{name}"))
        rows = readers.read_json(spark, out, schemas.RAW_SCHEMAS[name], multi_line=False)
        landed.append(
            rows.select(
                F.lit(label).alias("stream"),
                F.col(key).alias("record_id"),
                "user_id",
                F.col(measure).cast("double").alias("measure"),
            )
        )
    return quality.stacked(landed)


@query("stream_foreachbatch")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches written idempotently; the second run on the same checkpoint finds nothing new."""
    root = scratch_path(spark, "stream-batches")
    ingest.publish_messages(Warehouse.over(spark, sf_dir)["raw_cdrs"], f"{root}/topic")
    for _ in range(2):
        stream = ingest.consume_topic(spark, f"{root}/topic", schemas.CDRS, required=schemas.REQUIRED["raw_cdrs"])
        ingest.drain(ingest.land_batches(stream, f"{root}/out", f"{root}/checkpoint"))
    written = readers.read_optional(
        spark, schemas.CDRS, lambda: spark.read.schema(schemas.CDRS).parquet(f"{root}/out")
    )
    return plain_timestamps(written.drop("batch_id"))


@query("stream_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in which a fifth of the messages is delivered twice."""
    root = scratch_path(spark, "stream-dedup")
    for delivery in _redelivered_calls(spark, sf_dir):
        ingest.publish_messages(delivery, f"{root}/topic")
    stream = ingest.consume_topic(spark, f"{root}/topic", schemas.CDRS, required=schemas.REQUIRED["raw_cdrs"])
    unique = ingest.drop_redelivered(stream, "call_id", spread=8)
    ingest.drain(ingest.land_parquet(unique, f"{root}/out", f"{root}/checkpoint"))
    return plain_timestamps(spark.read.schema(schemas.CDRS).parquet(f"{root}/out"))


@query("stream_dedup_late")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the messages is delivered again after the state has forgotten them."""
    root = scratch_path(spark, "stream-late")
    landed = LandedKeys(spark, f"{root}/out", "call_id")
    for delivery in _redelivered_calls(spark, sf_dir):
        ingest.publish_messages(delivery, f"{root}/topic")
        stream = ingest.consume_topic(spark, f"{root}/topic", schemas.CDRS, required=schemas.REQUIRED["raw_cdrs"])
        unique = ingest.drop_redelivered(stream, "call_id", horizon="1 millisecond")
        ingest.drain(land_once(unique, landed, f"{root}/checkpoint"))
    return plain_timestamps(landed.rows(schemas.CDRS))


@query("stream_staging")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-staging")
    staged = stg_cdrs(bindings.calls_from_events(ingest.table_stream(spark, sf_dir, "events")))
    ingest.drain(ingest.land_parquet(staged, f"{root}/out", f"{root}/checkpoint"))
    return plain_timestamps(spark.read.schema(staged.schema).parquet(f"{root}/out"))


@query("stream_fct_calls")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-facts")
    calls = bindings.calls_from_events(ingest.table_stream(spark, sf_dir, "events"))
    ingest.drain(ingest.call_facts_stream(calls, f"{root}/out", f"{root}/checkpoint"))
    ingest.compact_call_facts(spark, f"{root}/out")
    return ingest.latest_call_facts(spark, f"{root}/out")


@query("stream_pull")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls pulled from a spool in bounded pulls, until all are there; a second run finds the spool empty."""
    root = scratch_path(spark, "stream-pull")
    expected = spool.publish_to_spool(Warehouse.over(spark, sf_dir)["raw_cdrs"], f"{root}/spool")
    spool.register_spool(spark)
    for empty_pulls in (5, 2):
        options = spool.spool_options(f"{root}/spool", "cdr", max(5000, -(-expected // 4)), expected if expected else None)
        stream = ingest.consume_topic(spark, None, schemas.CDRS, source="spool", options=options, required=schemas.REQUIRED["raw_cdrs"])
        landing = ingest.json_landing(stream, f"{root}/landed", f"{root}/checkpoint")
        expected -= spool.pull_until(spark, landing, expected + 1 if empty_pulls == 2 else expected, empty_pulls, "100 milliseconds")
    return plain_timestamps(readers.read_json(spark, f"{root}/landed", schemas.CDRS, multi_line=False))


@query("stream_fct_transfers")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of transfers in several micro-batches, compacted in the middle."""
    root = scratch_path(spark, "stream-transfers")
    topic, out, checkpoint = f"{root}/topic", f"{root}/out", f"{root}/checkpoint"
    transfers = Warehouse.over(spark, sf_dir)["raw_transfers"]
    first_half = F.crc32("transfer_id") % 2 == 0
    for part in (transfers.where(first_half), transfers.where(~first_half)):
        ingest.publish_messages(part, topic)
        stream = ingest.consume_topic(spark, topic, schemas.TRANSFERS, required=schemas.REQUIRED["raw_transfers"])
        ingest.drain(ingest.transfer_facts_stream(stream, out, checkpoint))
        ingest.compact_transfer_facts(spark, out)
    return ingest.latest_transfer_facts(spark, out)


# --- machine learning ----------------------------------------------------------------------------------------
on_tables("ml_features", fraud.training_table, FRAUD)
on_tables("ml_label_balance", lambda mart: fraud.label_balance(fraud.training_table(mart)), FRAUD)
on_tables(
    "ml_split",
    lambda mart: fraud.training_table(mart).select(
        "user_id", "is_fraud", fraud.in_training_set(F.col("user_id")).alias("is_training")
    ),
    FRAUD,
)
on_tables(
    "ml_split_exact",
    lambda mart: fraud.stratified(fraud.training_table(mart)).select("user_id", "is_fraud", "is_training"),
    FRAUD,
)
on_tables("ml_rule_figures", lambda mart: fraud.rule_figures(fraud.training_table(mart)), FRAUD)
on_tables("ml_feature_areas", lambda mart: fraud.feature_areas(fraud.training_table(mart)), FRAUD)
on_tables("ml_class_weights", lambda mart: fraud.class_weights(fraud.split(fraud.training_table(mart))[0]), FRAUD)


def _training_and_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The feature table is written once: every boosting round reads it again."""
    table = fraud.training_table(Warehouse.over(spark, sf_dir)[FRAUD])
    return fraud.split(settle(spark, table, "ml-features"))


#: F1 that the best classifier must reach on users it has not seen, with and without the label's own features.
LEAST_F1, LEAST_HONEST_F1 = 0.9, 0.3


def _metric_checks(spark: SparkSession, scores, best: str, least: float) -> DataFrame:
    """One row per classifier: what holds for its metrics. The figures themselves are ``fraud.metrics_table``."""
    table = fraud.metrics_table(spark, scores, best)
    inside = [F.col(c).between(0.0, 1.0) for c in ("accuracy", "precision", "recall", "f1", "auc_roc")]
    top = max(score["f1"] for score in scores.values())
    return table.select(
        "model",
        reduce(lambda a, b: a & b, inside).alias("in_range"),
        (~F.col("is_best") | (F.col("f1") == top)).alias("best_has_top_f1"),
        F.lit(top >= least).alias("top_f1_reached"),
    )


@query("ml_metrics")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scores, best = fraud.compare(*_training_and_test(spark, sf_dir))
    return _metric_checks(spark, scores, best, LEAST_F1)


@query("ml_metrics_without_label_features")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scores, best = fraud.compare(*_training_and_test(spark, sf_dir), features=fraud.HONEST_FEATURES)
    return _metric_checks(spark, scores, best, LEAST_HONEST_F1)


@query("ml_confusion")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per actual label, as the cells of the confusion matrix add up."""
    train, test = _training_and_test(spark, sf_dir)
    cells = fraud.confusion(fraud.predict(fraud.fit(train, fraud.FOREST), test))
    rows = cells.select(
        (F.col("true_safe") + F.col("false_fraud")).alias("0"), (F.col("false_safe") + F.col("true_fraud")).alias("1")
    )
    return rows.unpivot([], ["0", "1"], "label", "rows").select(F.col("label").cast("int").alias("is_fraud"), "rows")


@query("ml_feature_importance")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per feature: its weight is a share, and all weights add up to one."""
    train, _ = _training_and_test(spark, sf_dir)
    ranked = fraud.feature_importance(spark, fraud.fit(train, fraud.FOREST))
    total = ranked.agg(F.sum("importance").alias("total"))
    return ranked.select(
        "feature",
        F.col("importance").between(0.0, 1.0).alias("is_share"),
        (F.abs(total.scalar() - 1) < 1e-9).alias("sums_to_one"),
    )


@query("ml_persist")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best classifier, saved and reloaded: its predictions on the test users are those from before."""
    train, test = _training_and_test(spark, sf_dir)
    models, _, best = fraud.compare(train, test)
    path = scratch_path(spark, "ml-model")
    fraud.save(models[best], path)
    both = fraud.predict(models[best], test).select(
        "user_id", F.col("prediction").alias("prediction_before"), *fraud.FEATURES
    )
    again = fraud.predict(fraud.load(path), both)
    return again.select("user_id", (F.col("prediction_before") == F.col("prediction")).alias("same_prediction"))
