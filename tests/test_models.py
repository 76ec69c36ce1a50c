"""Invariants of the models, their behaviour under skew, on empty input and with missing keys, and plan shape."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.operators import quality
from remitlens.operators.dedup import first_per_key
from remitlens.plans import marts, staging, views
from remitlens.plans.facts import fct_financial_transfers, fct_telecom_calls, transfer_totals
from remitlens.plans.models import MODELS, Warehouse
from remitlens.plans.runner import catalog_store, file_store, run_counted, run_models
from remitlens.registry import QUERIES
from remitlens.sources.snapshots import SnapshotStore
from remitlens.sources.writers import create_namespace, known_rows


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Warehouse.over(spark, sf_dir)


def users(df):
    return {row[0] for row in df.select("user_id").collect()}


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_marts_hold_each_user_once(tables):
    facts = {name: users(tables[name]) for name in schemas.FACT_TABLES}
    fraud = [row[0] for row in tables["mart_fraud_prevention"].select("user_id").collect()]
    everyone = [row[0] for row in tables["mart_customer_360"].select("user_id").collect()]
    without_payments = set().union(*[facts[name] for name in schemas.FACT_TABLES if name != "fct_payments"])
    assert len(fraud) == len(set(fraud)) and set(fraud) == without_payments
    assert len(everyone) == len(set(everyone)) and set(everyone) == without_payments | facts["fct_payments"]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_aligning_facts_survives_many_partitions(spark, sf_dir, adaptive):
    """The stacked facts must stay aligned by user whatever AQE does to the partitions."""
    saved = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for mart in ("mart_fraud_prevention", "mart_customer_360"):
            df = Warehouse.over(spark, "/root/testdata/sf0.01")[mart]
            total, distinct = df.agg(F.count("*"), F.count_distinct("user_id")).first()
            assert total == distinct > 1000
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_fraud_mart_shuffles_only_the_facts(spark, sf_dir):
    """One shuffle per fact; aligning the three facts adds none. Broadcasts are off so that joins would show."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tables = Warehouse.over(spark, sf_dir)
    stored = [tables["fct_telecom_calls"], transfer_totals(tables["stg_transfers"]), tables["fct_support_tickets"]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        separate = sum(shuffles(fact) for fact in stored)
        assert shuffles(marts.mart_fraud_prevention(*stored)) == separate
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = QUERIES["churn_distribution"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "l_tax" not in plan and "n_name" not in plan and "o_orderpriority" not in plan
    payments = QUERIES["payment_status_counts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in payments


def test_totals(tables):
    staged = tables["stg_transfers"].count()
    corridors = tables["mart_corridor_analytics"].agg(F.sum("total_transfers"), F.sum("fraud_count")).first()
    facts = tables["fct_financial_transfers"].agg(F.sum("total_transfers"), F.sum("fraud_transfers")).first()
    assert tuple(corridors) == tuple(facts) and facts[0] == staged
    health = tables["mart_customer_360"].agg(F.min("customer_health_score"), F.max("customer_health_score")).first()
    assert 0 <= health[0] <= health[1] <= 100


def test_lean_transfer_totals_equal_the_full_fact(tables):
    lean = transfer_totals(tables["stg_transfers"])
    full = tables["fct_financial_transfers"].select(*lean.columns)
    assert lean.exceptAll(full).isEmpty() and full.exceptAll(lean).isEmpty()


def test_rows_without_keys_are_dropped(spark):
    rows = [("C1", "U1"), (None, "U1"), ("C2", None)]
    raw = spark.createDataFrame(rows, "call_id string, user_id string").selectExpr(
        "call_id", "user_id", "60L AS duration_seconds", "true AS connection_success", "4.0D AS call_quality_score",
        "99.0D AS delivery_rate_percent", "timestamp'2024-01-01' AS timestamp",
    )
    assert [r[0] for r in staging.stg_cdrs(raw).select("call_id").collect()] == ["C1"]


def test_empty_inputs(spark):
    raw = {name: spark.createDataFrame([], schema) for name, schema in schemas.RAW_SCHEMAS.items()}
    tables = Warehouse({name: (lambda df=df: df) for name, df in raw.items()})
    network = tables["mart_network_quality"].first()
    assert network["total_calls"] == 0 and network["connection_success_rate_pct"] is None
    for name in MODELS:
        if name != "mart_network_quality":
            assert tables[name].count() == 0


def hot_transfers(spark, rows=30_000):
    """A third of all transfers by one user on one route."""
    index = F.col("id")
    hot = index % 3 == 0
    return spark.range(rows).select(
        F.concat(F.lit("T"), index % 5000).alias("transfer_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("U"), index % 700)).alias("user_id"),
        F.when(hot, F.lit("us")).otherwise(F.concat(F.lit("s"), index % 7)).alias("sender_country"),
        F.when(hot, F.lit("mx")).otherwise(F.concat(F.lit("r"), index % 11)).alias("receiver_country"),
        (index % 1500 + 0.25).alias("transfer_amount_usd"),
        (index % 17 == 0).alias("is_fraud_flag"),
    )


def test_hot_user_and_route(spark):
    raw = hot_transfers(spark)
    per_user, per_route = defaultdict(list), defaultdict(list)
    for row in raw.collect():
        per_user[row.user_id].append(row)
        per_route[(row.sender_country.upper(), row.receiver_country.upper())].append(row)
    staged = staging.stg_transfers(raw)
    for fact in fct_financial_transfers(staged).collect():
        rows = per_user[fact.user_id]
        assert fact.total_transfers == len(rows)
        assert fact.total_transfer_usd == sum(r.transfer_amount_usd for r in rows)
        assert fact.distinct_corridors == len({(r.sender_country, r.receiver_country) for r in rows})
        assert fact.fraud_transfers == sum(r.is_fraud_flag for r in rows)
    found = marts.mart_corridor_analytics(staged).collect()
    assert len(found) == len(per_route)
    for mart in found:
        rows = per_route[(mart.sender_country, mart.receiver_country)]
        assert mart.total_transfers == len(rows)
        assert mart.unique_senders == len({r.user_id for r in rows})


def test_dedup_of_a_hot_key(spark):
    """A third of all rows are copies and variants of one key; the winner is the smallest variant, NULL first."""
    rows = [("HOT", i % 50 if i % 9 else None, f"v{i % 4}") for i in range(6000)]
    rows += [(f"K{i % 4000}", i % 3, None if i % 2 else "x") for i in range(12_000)]
    best: dict[str, tuple] = {}
    for key, number, text in rows:
        order = ((number is not None, number or 0), (text is not None, text or ""))
        best[key] = min(best.get(key, (order, number, text)), (order, number, text), key=lambda item: item[0])
    df = spark.createDataFrame(rows, "k string, n bigint, t string").repartition(5)
    got = {row.k: (row.n, row.t) for row in first_per_key(df, "k").collect()}
    assert got == {key: (number, text) for key, (_, number, text) in best.items()}


def test_duplicates_and_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "user_id string")
    parent = spark.createDataFrame([("b",), ("b",)], "user_id string")
    assert users(quality.orphan_keys("child", child, parent, "user_id")) == {"a", "c"}
    found = quality.duplicate_keys("child", child, "user_id").collect()
    assert [(row.key_value, row.copies) for row in found] == [("b", 2)]


def test_non_empty_check_reports_missing_and_empty_tables(spark):
    tables = {"raw_cdrs": spark.range(3), "raw_tickets": spark.range(0), "raw_payments": None}
    got = {row.table_name: (row.rows, row.status) for row in quality.non_empty_check(tables, schemas.LAYERS).collect()}
    assert got == {"raw_cdrs": (3, "OK"), "raw_tickets": (0, "EMPTY"), "raw_payments": (None, "MISSING")}


def raw_inputs(tables):
    return {name: tables[name] for name in schemas.RAW_TABLES}


def test_run_skips_dependents_of_a_failed_model(tables, tmp_path):
    save = file_store(str(tmp_path))

    def failing(name, df):
        if name == "fct_payments":
            raise OSError("disk full")
        return save(name, df)

    written, runs = run_models(raw_inputs(tables), failing)
    status = {run.model: run.status.split(":")[0] for run in runs}
    assert Counter(status.values()) == {"PASS": 10, "FAIL": 1, "SKIPPED": 2}
    assert status["mart_customer_360"] == status["mart_revenue_analytics"] == "SKIPPED"
    assert "fct_payments" not in written and [run.model for run in runs] == list(MODELS)


@pytest.mark.parametrize("kind", ["files", "catalog"])
def test_a_failed_model_keeps_its_former_table(spark, tables, tmp_path, kind):
    database = "kept_run"
    create_namespace(spark, database, str(tmp_path / "db"))
    save = file_store(str(tmp_path / "files")) if kind == "files" else catalog_store(database)
    raw = raw_inputs(tables)
    _, first = run_models(raw, save)
    boom = F.when(F.col("transaction_id") == "x", "x").otherwise(F.raise_error(F.lit("half way")))
    broken = raw["raw_payments"].withColumn("subscription_plan", boom)
    written, second = run_models({**raw, "raw_payments": broken}, save)
    assert {run.model: run.status.split(":")[0] for run in second if run.status != "PASS"} == {
        "stg_payments": "FAIL", "fct_payments": "SKIPPED", "mart_customer_360": "SKIPPED", "mart_revenue_analytics": "SKIPPED"
    }
    assert "stg_payments" not in written
    rows = {run.model: run.rows for run in first}
    for name in ("stg_payments", "fct_payments", "stg_cdrs"):
        if kind == "files":
            store = SnapshotStore(spark, f"{tmp_path}/files/{name}")
            assert store.read(tables[name].schema).count() == rows[name]
        else:
            assert spark.table(f"{database}.{name}").count() == rows[name] == known_rows(spark, f"{database}.{name}")


def test_rows_of_a_run_are_counted_by_its_writes(spark, tables, tmp_path):
    """No job of a run or of the check reads a table only to count it."""
    raw = raw_inputs(tables)
    written, runs, read = run_counted(raw, file_store(str(tmp_path)), workers=3)
    assert {run.model: run.rows for run in runs} == {name: written[name].count() for name in MODELS}
    assert read == {name: tables[name].count() for name in schemas.RAW_TABLES}
    known = {**read, **{run.model: run.rows for run in runs}}
    check = quality.non_empty_check({**raw, **{name: written[name] for name in MODELS}, "mart_none": None}, {**schemas.LAYERS, "mart_none": "MART"}, known)
    assert "Scan parquet" not in check._jdf.queryExecution().executedPlan().toString()
    assert {row.status for row in check.collect() if row.table_name != "mart_none"} == {"OK"}


def test_bucketed_facts_give_the_same_marts_without_shuffles(spark, tables):
    create_namespace(spark, "bucketed_run")
    written, runs = run_models(raw_inputs(tables), catalog_store("bucketed_run", fact_buckets=4))
    assert {run.status for run in runs} == {"PASS"}
    mart = tables["mart_revenue_analytics"].drop("refreshed_at")
    stored = written["mart_revenue_analytics"].drop("refreshed_at")
    assert mart.exceptAll(stored).isEmpty() and stored.exceptAll(mart).isEmpty()
    facts = [written[name] for name in ("fct_payments", "fct_telecom_calls", "fct_financial_transfers")]
    assert shuffles(marts.mart_revenue_analytics(*facts)) == 0


def test_executive_figures_shuffle_the_transfers_once(spark, sf_dir):
    df = QUERIES["executive_kpis"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The shuffled transfers of the fraud mart serve the total of the raw transfers too.
    assert any("ReusedExchange [l_orderkey" in line and "l_extendedprice" in line for line in plan.splitlines())


def test_views_are_queryable_by_name(spark, tables):
    views.register_views(spark, tables)
    assert spark.sql("SELECT SUM(users) FROM vw_fraud_summary").first()[0] == 149
    assert spark.sql("SELECT MAX(volume_rank) FROM vw_corridor_top20").first()[0] == 20


def test_views_outlive_the_session(spark, tables, tmp_path):
    database = "lasting_views"
    create_namespace(spark, database, str(tmp_path / "db"))
    raw = raw_inputs(tables)
    run_models(raw, catalog_store(database))
    views.create_views(spark, database)
    second = spark.newSession()
    for name, (build, mart) in views.VIEWS.items():
        want, got = build(tables[mart]), second.sql(f"SELECT * FROM {database}.{name}")
        assert got.columns == want.columns and [f.dataType for f in got.schema.fields] == [f.dataType for f in want.schema.fields]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # They show the tables of the last run, and may be created again.
    run_models({**raw, "raw_payments": raw["raw_payments"].limit(0)}, catalog_store(database))
    views.create_views(spark, database)
    # A session that has read a table keeps to the rows it knows until it is told to look again.
    assert second.sql(f"SELECT COUNT(*) FROM {database}.vw_revenue_by_plan").first()[0] == 5
    second.catalog.refreshTable(f"{database}.mart_revenue_analytics")
    assert second.sql(f"SELECT COUNT(*) FROM {database}.vw_revenue_by_plan").first()[0] == 0
    assert spark.newSession().sql(f"SELECT COUNT(*) FROM {database}.vw_revenue_by_plan").first()[0] == 0
    assert second.sql(f"SELECT SUM(users) FROM {database}.vw_fraud_summary").first()[0] == 149


def test_call_facts_of_one_hot_user(spark):
    raw = spark.range(9000).select(
        F.concat(F.lit("C"), "id").alias("call_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("U"), F.col("id") % 50)).alias("user_id"),
        (F.col("id") % 700).alias("duration_seconds"),
        (F.col("id") % 4 != 0).alias("connection_success"),
        (F.col("id") % 500 / 100).alias("call_quality_score"),
        F.lit(90.0).alias("delivery_rate_percent"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
    )
    hot = fct_telecom_calls(staging.stg_cdrs(raw)).where("user_id = 'HOT'").first()
    assert hot.total_calls == 3000 and hot.failed_calls == 750 and hot.call_failure_rate_pct == 25.0


def test_transfer_fact_takes_two_shuffles_and_no_expansion(spark, sf_dir):
    from remitlens.plans import facts
    from remitlens.schemas import TRANSFERS
    from remitlens.plans.staging import stg_transfers

    rows = [(f"t{i}", "hot" if i % 3 else f"u{i % 7}", None if i % 11 == 0 else f"c{i % 5}", f"d{i % 4}", 10.0 + i, i % 2 == 0) for i in range(400)]
    staged = stg_transfers(spark.createDataFrame(rows, TRANSFERS))
    fact = facts.fct_financial_transfers(staged)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 2
    hot = fact.where("user_id = 'USR-HOT' or user_id = 'hot'").first()
    mine = [r for r in rows if r[1] == "hot"]
    assert hot["total_transfers"] == len(mine)
    assert hot["distinct_sender_countries"] == len({r[2] for r in mine} - {None})
    assert hot["distinct_receiver_countries"] == len({r[3] for r in mine})
    assert hot["distinct_corridors"] == len({(r[2], r[3]) for r in mine if r[2]})


def test_sessions_are_sized_from_their_input():
    from remitlens import session

    assert session.initial_partitions(0) == 200
    assert session.initial_partitions(100 * 10**12) == 745_059
    assert session.is_local("local[8]") and session.is_local("local")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")
    with pytest.raises(ValueError, match="input_bytes"):
        session.build_session()


def test_scratch_is_removed_by_its_owner_only(spark):
    from remitlens import session

    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="shared folder"):
        session.remove_scratch(spark, "/elsewhere/data")
