"""Landing each message once, however late its copies come.

``ingest.drop_redelivered`` forgets a key after its horizon. Here the keys that have landed are kept as a table, and a batch is
checked against it in two steps:

1. A blocked Bloom filter: a key belongs to one block of 32 768 bits and sets ``HASHES`` of them. The batch's keys meet their blocks
   in one join; those with a bit unset are new for certain, and nearly all new ones are.
2. The others are looked up in the key table, which is partitioned by a hash of the key: only the partitions of suspected keys are
   read, and keys are compared as they are. So the filter decides what is read, and never what is dropped.

Rows, keys and filter blocks of a batch are one folder of a snapshot store and become visible together; a repeated batch changes
nothing. Blocks and keys of all batches add up: the filter is the OR of its parts, and compaction folds them. The query holds no state of
its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from remitlens.session import settle
from remitlens.sources.snapshots import Part, SnapshotStore

#: Bits of a block (the size of Spark's bitmaps), and bits that a key sets. A block serves some 3 000 keys.
BLOCK_BITS, HASHES = 32_768, 5
ROWS, KEYS, FILTER = "rows", "keys", "filter"
_KEYS = T.StructType([T.StructField("key", T.StringType()), T.StructField("bucket", T.IntegerType())])
_FILTER = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("bigint")


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)).cast("bigint") for i in range(HASHES)]


def filter_of(keys: DataFrame, blocks: int) -> DataFrame:
    """block and bits of a table of keys."""
    set_bits = keys.select(_block(F.col("key"), blocks).alias("block"), F.explode(F.array(*_places(F.col("key")))).alias("place"))
    return set_bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def merged_filter(parts: DataFrame) -> DataFrame:
    return parts.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def suspects(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The keys whose bits are all set: all that are in the filter, and a few others."""
    placed = keys.withColumn("_block", _block(F.col("key"), blocks))
    met = placed.join(bloom, F.col("_block") == F.col("block"))
    return met.where(reduce(lambda a, b: a & b, [_is_set(F.col("bits"), place) for place in _places(F.col("key"))])).select(*keys.columns)


class LandedKeys:
    """The rows that have landed under a folder, with their keys and the filter over them.

    ``blocks`` and ``buckets`` belong to the folder and stay as they were at first. ``blocks`` is the expected number of keys / 3 000; with
    more keys the filter suspects more, and results stay the same. ``buckets`` bounds the list of partitions that the driver sees.
    """

    def __init__(self, spark: SparkSession, out: str, key: str, blocks: int = 1024, buckets: int = 256):
        self._spark, self._key, self._blocks, self._buckets = spark, key, blocks, buckets
        self.store = SnapshotStore(spark, out)

    def rows(self, schema: T.StructType) -> DataFrame:
        return self.store.read(schema, part=ROWS)

    def _known(self, keys: DataFrame, snapshot) -> DataFrame | None:
        """Those keys that have landed; None if none can have."""
        suspected = settle(self._spark, suspects(keys, merged_filter(self.store.read(_FILTER, snapshot, FILTER)), self._blocks), "suspects")
        buckets = [row[0] for row in suspected.select("bucket").distinct().collect()]
        if not buckets:
            return None
        landed = self.store.read(_KEYS, snapshot, KEYS).where(F.col("bucket").isin(buckets))
        return suspected.join(landed.select("key", "bucket"), ["key", "bucket"], "left_semi").select("key")

    def new_rows(self, batch: DataFrame, snapshot) -> DataFrame:
        """The rows whose key has not landed, one of each key."""
        unique = batch.dropDuplicates([self._key])
        if not snapshot.folders:
            return unique
        unique = settle(self._spark, unique, "unique-rows")
        known = self._known(self._keyed(unique), snapshot)
        return unique if known is None else unique.join(known, F.col(self._key).cast("string") == F.col("key"), "left_anti")

    def _keyed(self, rows: DataFrame) -> DataFrame:
        key = F.col(self._key).cast("string")
        return rows.select(key.alias("key"), F.pmod(F.xxhash64(key), F.lit(self._buckets)).cast("int").alias("bucket"))

    def land(self, batch: DataFrame, writer: str, number: int) -> None:
        """Adds the new rows of a batch; a repeated batch of the same writer adds nothing."""

        def parts(snapshot) -> dict[str, Part]:
            rows = self.new_rows(batch, snapshot)

            def keys(folder: str) -> DataFrame:
                return self._keyed(self._spark.read.schema(rows.schema).parquet(f"{folder}/{ROWS}"))

            # The rows are computed and written once; keys and filter are made from what was written.
            return {ROWS: rows, KEYS: keys, FILTER: lambda folder: filter_of(keys(folder), self._blocks)}

        self.store.append_parts(batch, parts, writer, number, partitioned={KEYS: "bucket"})

    def compact(self, schema: T.StructType) -> None:
        """Folds all batches into one folder; the filter's parts into one row per block."""
        self.store.compact_parts(
            {ROWS: (schema, lambda rows: rows), KEYS: (_KEYS, lambda keys: keys), FILTER: (_FILTER, merged_filter)},
            partitioned={KEYS: "bucket"},
        )


def land_once(stream: DataFrame, landed: LandedKeys, checkpoint: str) -> StreamingQuery:
    """Land the messages of a stream whose key never landed before."""

    def write(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        landed.land(batch, query or checkpoint, number)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
