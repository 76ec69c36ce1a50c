"""Readers and writers on hand-made files."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.operators import filters, profiling
from remitlens.sources import loads, readers, writers

TICKET = {
    "ticket_id": "ZD-1",
    "user_id": "USR-1",
    "created_at": "2024-01-05T08:23:11Z",
    "updated_at": "2024-01-06T10:00:00Z",
    "issue_category": "call_drop",
    "priority": "high",
    "ticket_status": "solved",
    "satisfaction_score": 4,
}


def test_indented_json_arrays_at_any_depth(spark, tmp_path):
    for number, folder in enumerate(("a", "a/b")):
        (tmp_path / folder).mkdir()
        records = [{**TICKET, "ticket_id": f"ZD-{number}{i}"} for i in range(3)]
        (tmp_path / folder / "batch_001.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "notes.txt").write_text("not data")
    df = readers.read_json(spark, str(tmp_path), schemas.TICKET_SOURCE)
    assert df.count() == 6
    assert df.select("created_at").first()[0] == dt.datetime(2024, 1, 5, 8, 23, 11)


@pytest.mark.parametrize("text", ['[{"ticket_id": "ZD-1",', '[{"ticket_id": "ZD-1", "satisfaction_score": "four"}]'])
def test_malformed_json_fails(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|CANNOT_PARSE|FAILED_READ"):
        readers.read_json(spark, str(tmp_path), schemas.TICKET_SOURCE).collect()


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c,d,e\nTXN-1,USR-1,basic,not-a-number,success\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        readers.read_csv(spark, str(tmp_path), schemas.PAYMENTS).collect()


def test_csv_header_is_skipped_and_blanks_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("any,names,will,do,here\nTXN-1,USR-1, basic ,9.5,success\nTXN-2,USR-2,,,\n")
    rows = readers.read_csv(spark, str(tmp_path), schemas.PAYMENTS).orderBy("transaction_id").collect()
    assert [tuple(r) for r in rows] == [
        ("TXN-1", "USR-1", " basic ", 9.5, "success"),
        ("TXN-2", "USR-2", None, None, None),
    ]


def test_required_fields(spark):
    df = spark.createDataFrame([("TXN-1", None)], "transaction_id string, user_id string")
    with pytest.raises(Exception, match="required field user_id is missing"):
        readers.enforce_required(df, ("transaction_id", "user_id")).collect()
    good = spark.createDataFrame([("TXN-1", "U")], "transaction_id string, user_id string")
    assert readers.enforce_required(good, ("transaction_id", "user_id")).collect() == good.collect()


def test_missing_file_is_an_empty_table(spark, tmp_path):
    missing = str(tmp_path / "absent")
    df = readers.read_optional(spark, schemas.PAYMENTS, lambda: readers.read_csv(spark, missing, schemas.PAYMENTS))
    assert df.count() == 0 and df.schema == schemas.PAYMENTS


def test_numbers_are_coerced(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,), ("",)], "v string")
    assert [r[0] for r in filters.coerce_numeric(df, ["v", "not_there"]).collect()] == [1.5, 0.0, 0.0, 0.0]


def test_audit_columns(spark):
    moment = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)
    rows = readers.with_audit_columns(spark.range(50), moment).collect()
    assert len({r["_airbyte_ab_id"] for r in rows}) == 50
    assert {r["_airbyte_emitted_at"] for r in rows} == {dt.datetime(2024, 5, 1, 12)}


def test_arrays_hold_at_most_the_given_number_of_records(spark, tmp_path):
    source = spark.range(1050).select(F.col("id").cast("string").alias("ticket_id"), F.lit("U").alias("user_id"))
    out = str(tmp_path / "arrays")
    writers.land_json_arrays(source, out, records_per_array=100, one_array_per_file=False)
    sizes = [len(json.loads(r[0])) for r in spark.read.text(out).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1050


@pytest.mark.parametrize("records", [1, 7, 100, 5000])
def test_arrays_are_packed_without_a_shuffle(spark, records):
    source = spark.range(0, 3000, 1, 4).select(F.col("id").cast("string").alias("ticket_id"), F.lit(None).cast("string").alias("user_id"))
    packed = readers.as_json_arrays(source, records)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    arrays = [json.loads(r[0]) for r in packed.collect()]
    assert sorted(int(d["ticket_id"]) for a in arrays for d in a) == list(range(3000))
    assert max(map(len, arrays)) <= records and sum(len(a) < records for a in arrays) <= 4
    assert readers.as_json_arrays(source.limit(0), records).count() == 0


def test_append_repeats_and_overwrite_replaces(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        appended = writers.append_files(df, str(tmp_path / "a"))
        replaced = writers.replace_files(df, str(tmp_path / "r"))
    assert (appended.count(), replaced.count()) == (20, 10)


def test_csv_export_of_a_ledger_is_one_file(spark, tmp_path):
    writers.export_csv(spark.range(30).repartition(4), str(tmp_path / "csv"), single_file=True)
    files = list((tmp_path / "csv").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("id\n")


def test_filters(spark):
    df = spark.createDataFrame([("A", "x.y", 1), ("B", None, 2), (None, "XzY", 3)], "k string, t string, n int")
    assert filters.keep_selected(df, "k", ()).count() == 3
    assert filters.keep_selected(df, "k", ("A", "B")).count() == 2
    assert filters.keep_choice(df, "k", "ALL").count() == 3
    assert filters.keep_choice(df, "k", "B").count() == 1
    assert [r[0] for r in filters.filter_options(df, "k").collect()] == ["A", "B"]
    assert filters.search_all_columns(df, "x.y").count() == 2
    assert filters.search_all_columns(df, "none|nan|null").count() == 0


def test_histogram_edges(spark):
    values = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    got = {r.bin: r.rows for r in profiling.histogram(values, "v", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [tuple(r) for r in profiling.histogram(flat, "v", 5).collect()] == [(0, 3.0, 3.0, 2)]


def test_box_statistics(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    row = profiling.box_statistics(df, "g", "v").first()
    assert tuple(row) == ("g", 5, 1.0, 2.0, 3.0, 4.0, 100.0, -1.0, 7.0)


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_load_enforces_required_fields_and_keeps_the_table(spark, tmp_path, kind):
    schema = schemas.PAYMENTS
    good = [("t1", "u1", "gold", 1.5, "paid"), ("t2", "u2", None, None, None)]
    table = f"loaded_{kind}"
    for name, rows in (("good", good), ("bad", [*good, ("t3", None, "gold", 2.0, "paid")])):
        df, path = spark.createDataFrame(rows, schema), str(tmp_path / name)
        df.write.json(path) if kind == "json" else writers.export_csv(df, path)
    files = loads.read_files(spark, str(tmp_path / "good"), schema, kind=kind, multi_line=False)
    required = schemas.REQUIRED["raw_payments"]
    assert loads.load(files, table, required) == 2
    assert loads.load(files, table, required) == 2
    assert loads.load(files, table, required, loads.APPEND) == 4
    broken = loads.read_files(spark, str(tmp_path / "bad"), schema, kind=kind, multi_line=False)
    with pytest.raises(Exception, match="required field user_id is missing"):
        loads.load(broken, table, required, loads.APPEND)
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError, match="mode"):
        loads.load(files, table, required, "merge")


def test_box_statistics_round_before_counting(spark):
    df = spark.createDataFrame([("a", i + j / 1e6) for i in range(4) for j in range(50)], "g string, v double")
    counted = profiling.box_statistics(df, "g", "v", places=1).first()
    assert (counted["lowest"], counted["median"], counted["highest"], counted["rows"]) == (0.0, 1.5, 3.0, 200)


def _broken(spark, rows=100):
    """Fails when the last row is written."""
    bad = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 4).select(bad.alias("id"))


def _folders(root, name):
    return [p for p in root.iterdir() if p.name.startswith(name)]


@pytest.fixture
def database(spark, tmp_path):
    name = f"published_{tmp_path.name}".replace("-", "_").lower()
    writers.create_namespace(spark, name, str(tmp_path / "db"))
    return name


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_a_failed_truncating_load_keeps_the_former_rows(spark, tmp_path, database, kind):
    required, schema, table = schemas.REQUIRED["raw_payments"], schemas.PAYMENTS, f"{database}.raw_payments"
    good = [(f"t{i}", "u", "gold", 1.5, "paid") for i in range(10)]
    for name, rows in (("good", good), ("bad", [*good, ("t", None, "gold", 2.0, "paid")]), ("less", good[:3])):
        df, path = spark.createDataFrame(rows, schema), str(tmp_path / name)
        df.write.json(path) if kind == "json" else writers.export_csv(df, path)
    good_files, bad_files, less_files = [
        loads.read_files(spark, str(tmp_path / name), schema, kind=kind, multi_line=False) for name in ("good", "bad", "less")
    ]
    with pytest.raises(Exception, match="required field user_id is missing"):
        loads.load(bad_files, table, required)
    assert not spark.catalog.tableExists(table)  # a first load that fails leaves nothing
    assert not list((tmp_path / "db").iterdir())
    assert loads.load(good_files, table, required) == 10
    with pytest.raises(Exception, match="required field user_id is missing"):
        loads.load(bad_files, table, required)
    assert spark.table(table).count() == 10 and writers.known_rows(spark, table) == 10
    assert loads.load(less_files, table, required) == 3 and spark.table(table).count() == 3
    assert loads.load(less_files, table, required, loads.APPEND) == 6


def test_a_table_is_switched_in_one_step_and_former_rows_stay_readable(spark, tmp_path, database):
    table = f"{database}.t"
    for n in range(4):
        before = spark.table(table) if n else None
        written = writers.publish_table(spark.range(n + 1), table)
        assert (written.rows, written.table.count(), spark.table(table).count()) == (n + 1,) * 3
        if n:
            assert before.count() == n  # a plan made before the switch reads the former rows
    assert len(_folders(tmp_path / "db", "t-")) == 2  # this one and the former
    with pytest.raises(Exception, match="half way"):
        writers.publish_table(_broken(spark), table)
    assert spark.table(table).count() == 4 and len(_folders(tmp_path / "db", "t-")) == 2
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]


def test_a_table_may_change_its_columns_buckets_and_kind(spark, tmp_path, database):
    table = f"{database}.t"
    spark.range(7).write.saveAsTable(table)  # a managed table, made elsewhere
    assert writers.known_rows(spark, table) is None
    assert writers.publish_table(spark.range(5), table).table.count() == 5
    wider = spark.range(6).withColumn("more", F.lit("x"))
    assert writers.publish_table(wider, table).table.columns == ["id", "more"]
    assert writers.publish_table(wider, table, "id", 4).rows == 6
    plan = spark.table(table).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and spark.table(table).count() == 6
    assert writers.publish_table(wider.limit(2), table).table.count() == 2


def test_a_lost_rename_gives_the_name_back(spark, tmp_path, database, monkeypatch):
    table, run = f"{database}.t", type(spark).sql
    writers.publish_table(spark.range(5), table)

    def breaking(self, text, *args, **kwargs):
        if text.endswith(f"RENAME TO {table}") and "__was_" not in text.split(" RENAME")[0]:
            raise OSError("catalog is away")
        return run(self, text, *args, **kwargs)

    with monkeypatch.context() as patched, pytest.raises(OSError, match="catalog is away"):
        patched.setattr(type(spark), "sql", breaking)
        writers.publish_table(spark.range(5).withColumn("more", F.lit(1)), table)
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 5


def test_counts_of_appends_are_those_of_the_write(spark, database, monkeypatch):
    table = f"{database}.t"
    assert [writers.add_rows(spark.range(n), table).rows for n in (3, 4, 0)] == [3, 7, 7]
    with pytest.raises(Exception, match="half way"):
        writers.add_rows(_broken(spark), table)
    assert writers.known_rows(spark, table) is None  # unknown after a write that broke off
    assert writers.add_rows(spark.range(2), table).rows == 9 == writers.known_rows(spark, table)


def test_folders_are_replaced_when_complete(spark, tmp_path):
    path = str(tmp_path / "f")
    writers.replace_files(spark.range(5), path)
    with pytest.raises(Exception, match="half way"):
        writers.replace_files(_broken(spark), path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["f"]
    (tmp_path / "f").rename(tmp_path / "f.was")  # as a call leaves it that is cut between its renames
    assert writers.replace_files(spark.range(6), path).count() == 6
    assert [p.name for p in tmp_path.iterdir()] == ["f"]


def test_a_repeated_load_has_its_rows_once(spark, database):
    table = f"{database}.t"

    def load(name, numbers):
        rows = spark.range(*numbers).withColumn("text", F.lit(name))
        return writers.append_load(rows, table, name).rows

    def held():
        return {r.load_id: r["count"] for r in spark.table(table).groupBy("load_id").count().collect()}

    assert [load("a", (5,)), load("b'1 \\ x", (3,)), load("a", (5,))] == [5, 3, 5]
    assert held() == {"a": 5, "b'1 \\ x": 3}
    broken = _broken(spark).withColumn("text", F.lit("a"))
    with pytest.raises(Exception, match="half way"):
        writers.append_load(broken, table, "a")
    with pytest.raises(Exception, match="half way"):
        writers.append_load(broken, table, "c")
    assert held() == {"a": 5, "b'1 \\ x": 3}
    assert load("a", (2, 4)) == 2 and held() == {"a": 2, "b'1 \\ x": 3}
    assert load("a", (0,)) == 0 and held() == {"b'1 \\ x": 3}
    with pytest.raises(ValueError, match="has the columns"):
        writers.append_load(spark.range(3), table, "d")
    assert writers.add_rows(spark.range(3), f"{database}.plain").rows == 3
    assert writers.add_rows(spark.range(3), f"{database}.plain").rows == 6  # a plain append repeats
