"""Streams against their batch results, over several micro-batches and restarts."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.plans.facts import route_partials
from remitlens.plans.models import Warehouse
from remitlens.plans.staging import stg_transfers
from remitlens.session import prepare
from remitlens.sources import filesystem, readers
from remitlens.sources.loads import read_files
from remitlens.sources.snapshots import Conflict, SnapshotStore
from remitlens.streaming import ingest, spool
from remitlens.streaming import landed as landed_module
from remitlens.streaming.landed import LandedKeys, filter_of, land_once, merged_filter, suspects


@pytest.fixture
def calls(spark, sf_dir):
    return Warehouse.over(spark, sf_dir)["raw_cdrs"]


def equal(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_restart_adds_nothing_and_new_messages_are_picked_up(spark, calls, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))
    counts = []
    for delivery in (calls.limit(300), None, calls.limit(50)):
        if delivery is not None:
            ingest.publish_messages(delivery, topic)
        stream = ingest.consume_topic(spark, topic, schemas.CDRS)
        ingest.drain(ingest.land_json(stream, out, checkpoint))
        counts.append(spark.read.schema(schemas.CDRS).json(out).count())
    assert counts == [300, 300, 350]


def test_landing_files_respect_the_record_limit(spark, calls, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))
    ingest.publish_messages(calls.coalesce(1), topic)
    stream = ingest.consume_topic(spark, topic, schemas.CDRS)
    ingest.drain(ingest.land_json(stream, out, checkpoint, records_per_file=100))
    landed = spark.read.schema(schemas.CDRS).json(out)
    sizes = [r[0] for r in landed.groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(sizes) == 955 and max(sizes) <= 100
    assert equal(landed, calls)


def test_topics_and_landed_files_take_a_fraction_of_their_messages(spark, calls, tmp_path):
    topic, out, checkpoint = (str(tmp_path / name) for name in ("topic", "out", "checkpoint"))
    ingest.publish_messages(calls.coalesce(1), topic, messages_per_file=400)
    messages = spark.read.text(topic)
    assert messages.select(F.input_file_name()).distinct().count() == 3
    ingest.drain(ingest.land_json(ingest.consume_topic(spark, topic, schemas.CDRS), out, checkpoint))
    plain = messages.agg(F.sum(F.length("value") + 1)).first()[0]
    for folder, kind in ((topic, "txt"), (out, "json")):
        written = sum(path.stat().st_size for path in (tmp_path / folder).glob(f"part-*.{kind}*"))
        assert 0 < written < plain / 2
    assert equal(readers.read_json(spark, out, schemas.CDRS, multi_line=False), calls)
    assert equal(read_files(spark, out, schemas.CDRS, multi_line=False), calls)


def _plan(df, kind: str) -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_conditions_on_fields_parse_each_message_once(spark, sf_dir, tmp_path):
    transfers = Warehouse.over(spark, sf_dir)["raw_transfers"]
    ingest.publish_messages(transfers, str(tmp_path / "topic"))
    rows = ingest.parse_messages(spark.read.text(str(tmp_path / "topic")), schemas.TRANSFERS)
    assert _plan(route_partials(stg_transfers(rows)), "optimizedPlan").count("from_json") == 1
    assert equal(rows, transfers)


def test_partials_meet_once_for_the_facts(spark, sf_dir, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    transfers = Warehouse.over(spark, sf_dir)["raw_transfers"]
    ingest.publish_messages(transfers, topic)
    ingest.drain(ingest.transfer_facts_stream(ingest.consume_topic(spark, topic, schemas.TRANSFERS), out, str(tmp_path / "checkpoint")))
    facts = ingest.latest_transfer_facts(spark, out)
    assert _plan(facts, "executedPlan").count("Exchange hashpartitioning") == 1
    assert equal(facts, Warehouse.over(spark, sf_dir)["fct_financial_transfers"])


def test_landed_rows_are_written_once_and_state_keeps_no_row_count(spark, calls, tmp_path, monkeypatch):
    written, settled = [], landed_module.settle
    monkeypatch.setattr(landed_module, "settle", lambda spark, df, name: (written.append(name), settled(spark, df, name))[1])
    prepare(spark)
    for name, value in (("changelogCheckpointing.enabled", "true"), ("trackTotalNumberOfRows", "false")):
        assert spark.conf.get(f"spark.sql.streaming.stateStore.rocksdb.{name}") == value
    keys = LandedKeys(spark, str(tmp_path / "out"), "call_id", blocks=4, buckets=4)
    keys.land(calls, "writer", 0)
    assert written == [] and equal(keys.rows(schemas.CDRS), calls)
    keys.land(calls.unionByName(calls.limit(5).withColumn("call_id", F.concat("call_id", F.lit("-again")))), "writer", 1)
    assert "new-rows" not in written and keys.rows(schemas.CDRS).count() == calls.count() + 5


def test_unreadable_message_fails_the_query(spark, tmp_path):
    topic = str(tmp_path / "topic")
    spark.createDataFrame([("{broken",)], "value string").write.text(topic)
    stream = ingest.consume_topic(spark, topic, schemas.CDRS)
    with pytest.raises(Exception, match="MALFORMED|CANNOT_PARSE|STREAM_FAILED"):
        ingest.drain(ingest.land_json(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")))


@pytest.mark.parametrize(("name", "spread"), [("raw_cdrs", 1), ("raw_transfers", 1), ("raw_cdrs", 4)])
def test_redelivery_is_dropped_across_batches_and_restarts(spark, sf_dir, tmp_path, name, spread):
    """Transfers have no event time, calls do; both are deduplicated by arrival."""
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    key = schemas.REQUIRED[name][0]
    rows = Warehouse.over(spark, sf_dir)[name].dropDuplicates([key])
    for delivery in (rows, rows.where(F.crc32(key) % 3 == 0), rows.where(F.crc32(key) % 3 == 1)):
        ingest.publish_messages(delivery, topic)
        stream = ingest.consume_topic(spark, topic, schemas.RAW_SCHEMAS[name], max_files_per_batch=3)
        ingest.drain(ingest.land_parquet(ingest.drop_redelivered(stream, key, spread=spread), out, checkpoint))
    landed = spark.read.schema(schemas.RAW_SCHEMAS[name]).parquet(out)
    assert landed.count() == rows.count()
    assert landed.select(key).distinct().count() == landed.count()


def test_facts_follow_the_stream_over_several_batches(spark, sf_dir, calls, tmp_path):
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    for part in range(3):
        ingest.publish_messages(calls.where(F.crc32("call_id") % 3 == part).coalesce(1), topic)
        stream = ingest.consume_topic(spark, topic, schemas.CDRS, max_files_per_batch=1)
        ingest.drain(ingest.call_facts_stream(stream, out, checkpoint))
    assert ingest.call_facts_history(spark, out).select("version").distinct().count() >= 3
    batch = Warehouse.over(spark, sf_dir)["fct_telecom_calls"]
    assert equal(ingest.latest_call_facts(spark, out).select(*batch.columns), batch)


def test_tables_stream_from_a_file_or_a_folder(spark, sf_dir, tmp_path):
    """At scale a table is a folder of files, read under the same name."""
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    counts = []
    for number, source in enumerate((sf_dir, str(tmp_path))):
        out = str(tmp_path / f"out{number}")
        stream = ingest.table_stream(spark, source, "events")
        ingest.drain(ingest.land_parquet(stream, out, str(tmp_path / f"checkpoint{number}")))
        counts.append(spark.read.parquet(out).count())
    assert counts == [1000, 1000]


def test_a_flood_of_one_message(spark, calls, tmp_path):
    """A third of all deliveries are copies of one message."""
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    copies = calls.limit(1).crossJoin(spark.range(470)).drop("id")
    ingest.publish_messages(calls.unionByName(copies).repartition(6), topic)
    stream = ingest.consume_topic(spark, topic, schemas.CDRS, max_files_per_batch=2)
    ingest.drain(ingest.land_parquet(ingest.drop_redelivered(stream, "call_id", spread=4), out, checkpoint))
    assert equal(spark.read.schema(schemas.CDRS).parquet(out), calls)


def _states(spark, out, batches, writer="query"):
    """Commits batches of call facts in which each user's total says which batch is the newest."""
    schema = ingest.call_facts_schema(spark)
    blank = {f.name: None for f in schema.fields}
    for batch, users in batches:
        rows = [{**blank, "user_id": u, "total_calls": 10 * batch + 1} for u in users]
        frame = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
        SnapshotStore(spark, out).append_batch(frame, writer, batch)


def _totals(spark, out):
    return {r.user_id: r.total_calls for r in ingest.latest_call_facts(spark, out).collect()}


def test_compaction_changes_no_result_and_may_be_repeated(spark, tmp_path):
    out = str(tmp_path / "facts")
    assert ingest.compact_call_facts(spark, out).number == 0
    assert ingest.latest_call_facts(spark, out).count() == 0
    _states(spark, out, enumerate([("a", "b"), ("b", "c"), ("c",)]))
    expected = {"a": 1, "b": 11, "c": 21}
    for _ in range(3):
        assert _totals(spark, out) == expected
        assert len(ingest.compact_call_facts(spark, out).folders) == 1
    _states(spark, out, [(1, ("a",)), (2, ("a",))])  # delivered before
    assert _totals(spark, out) == expected
    _states(spark, out, [(3, ("a", "d"))])
    SnapshotStore(spark, out).expire(keep=1)
    assert _totals(spark, out) == {"a": 31, "b": 11, "c": 21, "d": 31}
    assert len(list((tmp_path / "facts" / "data").iterdir())) == 2


@pytest.mark.parametrize("step", ["write", "commit", "expire"])
def test_a_compaction_cut_at_any_step_changes_nothing(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "facts")
    _states(spark, out, enumerate([("a", "b"), ("b", "c"), ("c",)]))
    expected = {"a": 1, "b": 11, "c": 21}

    def fail(*args):
        raise OSError("cut")

    with monkeypatch.context() as patched, pytest.raises(Exception, match="cut"):
        if step == "write":
            bad = lambda rows: rows.withColumn("total_calls", F.raise_error(F.lit("cut")).cast("bigint"))
            patched.setattr(ingest, "_newest", bad)
        elif step == "commit":
            patched.setattr(filesystem, "create", fail)
        else:
            patched.setattr(filesystem, "remove", fail)
        ingest.compact_call_facts(spark, out)
        SnapshotStore(spark, out).expire(keep=1)
    assert _totals(spark, out) == expected
    _states(spark, out, [(3, ("c",))])
    ingest.compact_call_facts(spark, out)
    SnapshotStore(spark, out).expire(keep=1, orphan_hours=0)
    assert _totals(spark, out) == {**expected, "c": 31}
    assert len(list((tmp_path / "facts" / "data").iterdir())) == 1


def test_a_batch_that_fails_is_taken_again(spark, calls, sf_dir, tmp_path, monkeypatch):
    """The write of a micro-batch breaks off; the restarted stream repeats it, once."""
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    ingest.publish_messages(calls.where(F.crc32("call_id") % 2 == 0), topic)

    def run():
        stream = ingest.consume_topic(spark, topic, schemas.CDRS)
        ingest.drain(ingest.call_facts_stream(stream, out, checkpoint))

    run()
    before = _totals(spark, out)
    ingest.publish_messages(calls.where(F.crc32("call_id") % 2 == 1), topic)
    commit = SnapshotStore.commit

    def commit_and_die(self, *args, **kwargs):
        commit(self, *args, **kwargs)
        raise OSError("the driver is lost")

    with monkeypatch.context() as patched, pytest.raises(Exception, match="driver is lost"):
        patched.setattr(filesystem, "create", lambda *args: (_ for _ in ()).throw(OSError("the driver is lost")))
        run()
    assert _totals(spark, out) == before
    with monkeypatch.context() as patched, pytest.raises(Exception, match="driver is lost"):
        patched.setattr(SnapshotStore, "commit", commit_and_die)
        run()
    run()
    batch = Warehouse.over(spark, sf_dir)["fct_telecom_calls"]
    assert equal(ingest.latest_call_facts(spark, out).select(*batch.columns), batch)
    assert len(SnapshotStore(spark, out).latest().folders) == 2


def test_transfer_facts_add_up_over_batches_compactions_and_repeats(spark, sf_dir, tmp_path):
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    transfers = Warehouse.over(spark, sf_dir)["raw_transfers"]
    assert ingest.latest_transfer_facts(spark, out).count() == 0
    for part in range(3):
        ingest.publish_messages(transfers.where(F.crc32("transfer_id") % 3 == part).coalesce(2), topic)
        stream = ingest.consume_topic(spark, topic, schemas.TRANSFERS, max_files_per_batch=1)
        ingest.drain(ingest.transfer_facts_stream(stream, out, checkpoint))
        if part == 1:
            assert len(ingest.compact_transfer_facts(spark, out).folders) == 1
    store = SnapshotStore(spark, out)
    last = store.latest()
    writer, batch = next((k, v) for k, v in last.marks.items() if k != "sequence")
    assert store.append_batch(ingest.transfer_partials(spark, out).drop("version"), writer, batch) == last
    fact = Warehouse.over(spark, sf_dir)["fct_financial_transfers"]
    assert equal(ingest.latest_transfer_facts(spark, out).select(*fact.columns), fact)
    ingest.compact_transfer_facts(spark, out)
    assert equal(ingest.latest_transfer_facts(spark, out).select(*fact.columns), fact)


def test_a_snapshot_has_one_successor(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    first, rows = store.replace(spark.range(3))
    folder, more = store.stage(spark.range(3, 5))
    assert (rows, more) == (3, 2)
    second = store.commit(first, (*first.folders, folder))
    with pytest.raises(Conflict):
        store.commit(first, ())
    schema = spark.range(0).schema
    assert store.read(schema).count() == 5 and store.read(schema, first).count() == 3
    assert store.latest() == second
    # A batch that arrives while a compaction is being written stays beside it.
    writing = store.stage

    def late(df):
        staged = writing(df)
        if store.stage is not writing:
            store.stage = writing
            store.commit(store.latest(), (*store.latest().folders, writing(spark.range(5, 6))[0]))
        return staged

    store.stage = late
    store.compact(schema, lambda rows: rows)
    assert sorted(r.id for r in store.read(schema).collect()) == [0, 1, 2, 3, 4, 5] and len(store.latest().folders) == 2


def test_messages_without_a_key_fail_and_sources_are_free(spark, tmp_path):
    topic = str(tmp_path / "topic")
    spark.createDataFrame([('{"call_id": "c1"}',)], "value string").write.text(topic)
    for number, required in enumerate((schemas.REQUIRED["raw_cdrs"], None)):
        stream = ingest.consume_topic(spark, topic, schemas.CDRS, required=required)
        for kind, land in enumerate((ingest.land_parquet, ingest.land_json, ingest.land_batches)):
            with pytest.raises(Exception, match="required field user_id is missing"):
                ingest.drain(land(stream, str(tmp_path / f"out{number}{kind}"), str(tmp_path / f"check{number}{kind}")))
    rate = ingest.consume_topic(spark, None, schemas.CDRS, source="rate", options={"rowsPerSecond": "1"})
    assert rate.isStreaming and rate.columns == schemas.CDRS.names


@pytest.fixture
def pulled(spark, calls, tmp_path):
    """A spool of 955 messages, and a run of a subscription over it that lands what it pulls."""
    spool.register_spool(spark)
    path, out, checkpoint = (str(tmp_path / part) for part in ("spool", "out", "checkpoint"))
    assert spool.publish_to_spool(calls, path, segment=150) == 955

    def run(expected, empty_pulls=5):
        options = spool.spool_options(path, "calls", max_messages=100, expected=expected)
        stream = ingest.consume_topic(spark, None, schemas.CDRS, source="spool", options=options)
        taken = spool.pull_until(spark, ingest.json_landing(stream, out, checkpoint), expected, empty_pulls, "100 milliseconds")
        return taken, spark.read.schema(schemas.CDRS).json(out).count()

    return run, path, out


def test_pulls_stop_at_the_expected_count_and_go_on_from_there(spark, calls, pulled):
    run, path, out = pulled
    assert run(250) == (300, 300)  # pulls of 100 until 250 are there
    assert run(0) == (0, 300)
    assert run(100) == (100, 400)
    assert run(10_000, empty_pulls=2) == (555, 955)
    assert equal(spark.read.schema(schemas.CDRS).json(out), calls)


def test_pulls_stop_after_five_empty_ones_and_restarts_add_nothing(spark, calls, pulled):
    run, path, out = pulled
    assert run(None) == (955, 955)
    assert run(None) == (0, 955)
    spool.publish_to_spool(calls.limit(7), path)
    assert run(None, empty_pulls=1) == (7, 962)


def test_stop_rules():
    class Id(SimpleNamespace):
        pass

    rules = spool.StopRules(expected=10, empty_pulls=5)
    rules.query_id = "q"
    for _ in range(4):
        rules.onQueryIdle(Id(id="q"))
    rules.onQueryIdle(Id(id="another"))
    rules.onQueryProgress(Id(progress=Id(id="q", numInputRows=3)))  # a message starts the count anew
    for _ in range(4):
        rules.onQueryIdle(Id(id="q"))
    assert not rules.reached.is_set()
    rules.onQueryIdle(Id(id="q"))
    assert rules.reached.is_set()
    rules = spool.StopRules(expected=10, empty_pulls=5)
    rules.query_id = "q"
    rules.onQueryProgress(Id(progress=Id(id="q", numInputRows=9)))
    assert not rules.reached.is_set()
    rules.onQueryProgress(Id(progress=Id(id="q", numInputRows=1)))
    assert rules.reached.is_set() and rules.taken == 10


def test_a_failing_pull_raises_and_is_repeated(spark, calls, tmp_path):
    spool.register_spool(spark)
    path, out, checkpoint = (str(tmp_path / part) for part in ("spool", "out", "checkpoint"))
    spool.publish_to_spool(calls.limit(30), path)
    spool.publish_to_spool(calls.limit(1).withColumn("user_id", F.lit(None).cast("string")), path)

    def run(required):
        options = spool.spool_options(path, "calls", max_messages=20)
        stream = ingest.consume_topic(spark, None, schemas.CDRS, source="spool", options=options, required=required)
        return spool.pull_until(spark, ingest.json_landing(stream, out, checkpoint), None, 2, "100 milliseconds")

    with pytest.raises(Exception, match="required field user_id is missing"):
        run(None)
    assert spark.read.schema(schemas.CDRS).json(out).count() == 20
    assert run(()) == 11 and spark.read.schema(schemas.CDRS).json(out).count() == 31


def test_a_lost_position_fails_loudly(tmp_path):
    (tmp_path / "000000000000-5.txt").write_text("a\nb\nc\nd\ne\n")
    reader = spool.SpoolReader(spool.spool_options(str(tmp_path), "s", 2))
    assert reader.initialOffset() == {"message": 0}
    assert [reader.latestOffset()["message"] for _ in range(4)] == [2, 4, 5, 5]
    bounded = spool.SpoolReader(spool.spool_options(str(tmp_path), "b", 2, expected=3))
    assert [bounded.latestOffset()["message"] for _ in range(4)] == [2, 4, 4, 4]
    with pytest.raises(ValueError, match="position of the subscription was lost"):
        reader.partitions({"message": 5}, {"message": 2})
    slices = reader.partitions({"message": 1}, {"message": 4})
    assert [batch.column(0).to_pylist() for part in slices for batch in reader.read(part)] == [["b", "c", "d"]]
    assert spool.SpoolReader(spool.spool_options(str(tmp_path), "s", 2)).latestOffset() == {"message": 5}


@pytest.mark.parametrize("blocks", [1, 64])
def test_copies_after_the_horizon_are_dropped(spark, calls, tmp_path, blocks):
    """The state has forgotten the keys; the landed keys have not. One block for all keys suspects more and drops no more."""
    topic, out, checkpoint = (str(tmp_path / part) for part in ("topic", "out", "checkpoint"))
    landed = LandedKeys(spark, out, "call_id", blocks=blocks, buckets=8)

    def deliver(rows):
        ingest.publish_messages(rows, topic)
        stream = ingest.consume_topic(spark, topic, schemas.CDRS)
        query = land_once(ingest.drop_redelivered(stream, "call_id", horizon="1 millisecond"), landed, checkpoint)
        ingest.drain(query)
        return max((p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]), default=0)

    first, second = calls.where(F.crc32("call_id") % 2 == 0), calls.where(F.crc32("call_id") % 2 == 1)
    deliver(first)
    states = [deliver(rows) for rows in (first.where(F.crc32("call_id") % 3 == 0), first.unionByName(second))]
    assert max(states) <= calls.count() + first.count()  # state holds the last batches, not all that ever came
    assert equal(landed.rows(schemas.CDRS), calls)
    landed.compact(schemas.CDRS)
    assert len(landed.store.latest().folders) == 1 and equal(landed.rows(schemas.CDRS), calls)
    deliver(second.limit(40))
    assert equal(landed.rows(schemas.CDRS), calls)


def test_the_filter_misses_no_key_and_suspects_few(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("K"), "id").alias("key"), F.lit(0).alias("bucket"))
    old, new = keys.where("substring(key, 2) % 2 = 0"), keys.where("substring(key, 2) % 2 = 1")
    parts = filter_of(old.where(F.crc32("key") % 2 == 0), 8).unionByName(filter_of(old.where(F.crc32("key") % 2 == 1), 8))
    bloom = merged_filter(parts)
    assert bloom.count() == 8
    assert suspects(old, bloom, 8).count() == 10_000
    assert suspects(new, bloom, 8).count() < 200  # a hundredth is expected at the most
    assert suspects(keys, filter_of(keys.limit(0), 8), 8).count() == 0


def test_a_landing_that_fails_or_repeats(spark, tmp_path, monkeypatch):
    landed = LandedKeys(spark, str(tmp_path / "out"), "id", blocks=2, buckets=4)
    schema = spark.range(1).schema
    landed.land(spark.range(10), "q", 0)
    with monkeypatch.context() as patched, pytest.raises(OSError, match="cut"):
        patched.setattr(filesystem, "create", lambda *args: (_ for _ in ()).throw(OSError("cut")))
        landed.land(spark.range(5, 20), "q", 1)
    assert landed.rows(schema).count() == 10
    for _ in range(2):
        landed.land(spark.range(5, 20), "q", 1)
        assert sorted(r.id for r in landed.rows(schema).collect()) == list(range(20))
    landed.land(spark.range(3).unionByName(spark.range(3)), "another", 0)
    landed.land(spark.range(0), "q", 2)
    assert landed.rows(schema).count() == 20
