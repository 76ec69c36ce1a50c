"""Message streams: consume, land, deduplicate, stage and aggregate.

All queries drain what is available and stop; offsets are committed only after a batch is written, so a crash
repeats a batch instead of losing it, and every sink here is idempotent under such a repeat.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.query import StreamingQuery

from remitlens.plans.facts import fct_telecom_calls, merged_partials, route_partials, transfers_of_routes
from remitlens.plans.staging import stg_cdrs, stg_transfers
from remitlens.schemas import CDRS, TRANSFERS, required_of
from remitlens.sources.readers import JSON_TIMES, as_json, enforce_required
from remitlens.sources.snapshots import VERSION, Snapshot, SnapshotStore


def publish_messages(df: DataFrame, topic: str, messages_per_file: int = 200_000) -> None:
    """Write rows as one JSON message per line into a topic folder.

    Messages are compressed, as a broker keeps them. A compressed file is read by one task, so files are of bounded size.
    """
    writer = df.select(as_json(df).alias("value")).write.mode("append").option("compression", "lz4")
    writer.option("maxRecordsPerFile", messages_per_file).text(topic)


def parse_messages(messages: DataFrame, schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """Rows of the JSON documents in the ``value`` column; an unreadable message, or one without a required field,
    fails the query. The required fields of the raw schemas are known; for other schemas they are named.

    The column layout is that of a broker source, so consuming from a broker only changes the reader.
    """
    required = required_of(schema) if required is None else required
    options = {"mode": "FAILFAST", **JSON_TIMES}
    document = F.from_json(F.col("value").cast("string"), schema, options)
    # One row of a generator: conditions on its fields stay above it, where a plain projection would parse the message again for each.
    return enforce_required(messages.select(F.inline_outer(F.array(document))), required)


def consume_topic(
    spark: SparkSession,
    topic: str | None,
    schema: T.StructType,
    max_files_per_batch: int = 1000,
    *,
    source: str = "text",
    options: Mapping[str, str] | None = None,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """A topic as a stream of parsed rows, in micro-batches of bounded size.

    By default a topic is a folder of text files. Any other streaming source with a ``value`` column is named by
    ``source`` with its ``options`` (a broker takes its address, its topic and its own limit per batch there, and no path).
    """
    reader = spark.readStream.format(source).options(**(options or {}))
    if source == "text":
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return parse_messages(reader.load(topic) if topic else reader.load(), schema, required)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables as a stream, whether it is a single file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    table = spark.read.parquet(path)
    stream = spark.readStream.schema(table.schema)
    some_file = table.select("_metadata.file_path").first()
    if some_file is not None and some_file[0].endswith(f"/{name}.parquet"):
        # A file stream watches folders; a single file is picked by its name.
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return stream.parquet(path)


def drain(query: StreamingQuery) -> None:
    """Wait until everything available has been processed; a failed query raises here."""
    query.awaitTermination()


def json_landing(
    stream: DataFrame, out: str, checkpoint: str, records_per_file: int = 100_000, compression: str = "gzip"
) -> DataStreamWriter:
    """A writer of JSON lines in files of bounded size, to be started with a trigger."""
    return (
        stream.writeStream.format("json")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", compression)
        .options(**JSON_TIMES)
    )


def land_json(
    stream: DataFrame, out: str, checkpoint: str, records_per_file: int = 100_000
) -> StreamingQuery:
    """Land a stream as JSON lines in files of bounded size."""
    return json_landing(stream, out, checkpoint, records_per_file).trigger(availableNow=True).start()


def land_parquet(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_batches(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write each micro-batch into its own folder, replacing it when the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_redelivered(stream: DataFrame, key: str, horizon: str = "1 day", spread: int = 1) -> DataFrame:
    """Drop messages whose key was seen within the horizon.

    The watermark is taken from the arrival time. Arrival times never decrease, so no message is ever late and
    none is lost, and streams without an event time work too; state older than the horizon is discarded.

    All copies of a key meet in one state task. Where a single key can be delivered in floods, ``spread`` first removes
    copies within each of that many groups of source partitions, so that at most ``spread`` copies per horizon reach
    the task of the key. This costs a second shuffle and is off by default.
    """
    arrived = stream.withColumn("_arrived_at", F.current_timestamp()).withWatermark("_arrived_at", horizon)
    if spread > 1:
        grouped = arrived.withColumn("_group", F.spark_partition_id() % spread)
        arrived = grouped.dropDuplicatesWithinWatermark([key, "_group"]).drop("_group")
    return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived_at")


def _stored(stream: DataFrame, store: SnapshotStore, checkpoint: str, mode: str, prepare) -> StreamingQuery:
    """Commits each micro-batch to a snapshot store, once: a repeated batch of the same query is known by its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store.append_batch(prepare(batch), query or checkpoint, batch_id)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _with_version(schema: T.StructType) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema.fields), T.StructField(VERSION, T.LongType())])


# --- call facts: the newest state of each user ------------------------------------------------------------------
def call_facts_stream(raw_calls: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the call facts up to date: each micro-batch commits the new state of the users it touched to the store in ``out``."""
    store = SnapshotStore(raw_calls.sparkSession, out)
    return _stored(fct_telecom_calls(stg_cdrs(raw_calls)), store, checkpoint, "update", lambda batch: batch)


def call_facts_schema(spark: SparkSession) -> T.StructType:
    """Columns of the call facts, as Spark derives them from the raw schema."""
    fields = fct_telecom_calls(stg_cdrs(spark.createDataFrame([], CDRS))).schema.fields
    return T.StructType([T.StructField(field.name, field.dataType, True) for field in fields])


def _newest(history: DataFrame) -> DataFrame:
    columns = [name for name in history.columns if name not in ("user_id", VERSION)]
    newest = F.max_by(F.struct(*columns, VERSION), F.col(VERSION)).alias("newest")
    return history.groupBy("user_id").agg(newest).select("user_id", "newest.*")


def call_facts_history(spark: SparkSession, out: str) -> DataFrame:
    """All committed states since the last compaction, with their version; empty if nothing was committed yet."""
    return SnapshotStore(spark, out).read(_with_version(call_facts_schema(spark)))


def latest_call_facts(spark: SparkSession, out: str) -> DataFrame:
    """The newest committed state per user."""
    return _newest(call_facts_history(spark, out)).drop(VERSION)


def compact_call_facts(spark: SparkSession, out: str) -> Snapshot:
    """Fold all committed states into the newest one per user, as the next snapshot.

    May run beside the stream, be cut short at any point or be repeated: readers follow the former snapshot until the next
    one is committed. ``SnapshotStore.expire`` removes what no snapshot needs.
    """
    return SnapshotStore(spark, out).compact(_with_version(call_facts_schema(spark)), _newest)


# --- transfer facts: partial aggregates that add up -----------------------------------------------------------
def transfer_facts_stream(raw_transfers: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Add each micro-batch's partial aggregates by user and route to the store in ``out``.

    The query itself holds no state. Partials merge exactly, distinct countries and corridors included, as every route is a row; what
    is stored is bounded by the routes of the users and the batches since the last compaction.
    """
    store = SnapshotStore(raw_transfers.sparkSession, out)
    return _stored(stg_transfers(raw_transfers), store, checkpoint, "append", route_partials)


def _partials_schema(spark: SparkSession) -> T.StructType:
    return _with_version(route_partials(stg_transfers(spark.createDataFrame([], TRANSFERS))).schema)


def transfer_partials(spark: SparkSession, out: str) -> DataFrame:
    return SnapshotStore(spark, out).read(_partials_schema(spark))


def latest_transfer_facts(spark: SparkSession, out: str) -> DataFrame:
    """The transfer facts of all committed batches. A user's partials meet once, for the routes and for the user."""
    return transfers_of_routes(merged_partials(transfer_partials(spark, out).repartition("user_id")))


def compact_transfer_facts(spark: SparkSession, out: str) -> Snapshot:
    """Merge all committed partials into one row per user and route, as the next snapshot; as safe as ``compact_call_facts``."""

    def fold(partials: DataFrame) -> DataFrame:
        return merged_partials(partials).withColumn(VERSION, F.lit(None).cast("bigint"))

    return SnapshotStore(spark, out).compact(_partials_schema(spark), fold)
