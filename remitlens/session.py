"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Recording a call site per column expression costs more driver time than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
    # Streaming aggregates and dedup keep more keys than fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit writes the changes of its batch; whole snapshots are uploaded in the background. Counting the rows of the state would
    # cost one look-up for each row put or removed.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


# Results, state and memory depend on these; they are applied to sessions built elsewhere too.
NEEDED_SETTINGS = (
    "spark.sql.session.timeZone",
    "spark.sql.ansi.enabled",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.dataFrameQueryContext.enabled",
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows",
)
ADVISORY_BYTES = 128 << 20


def initial_partitions(input_bytes: int, advisory_bytes: int = ADVISORY_BYTES) -> int:
    """Shuffle partitions to start from. AQE merges small ones and never adds any, so the largest shuffle, taken to be as
    large as the input, must start with partitions of the advisory size; never fewer than Spark's default of 200."""
    return max(200, -(-input_bytes // advisory_bytes))


def is_local(master: str) -> bool:
    """One machine and one process. A local cluster has several processes and is not local in this sense."""
    return master == "local" or master.startswith("local[")


def build_session(
    app_name: str = "remitlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session for a cluster (master taken from spark-submit) or, when ``master`` is given, a local one.

    On a cluster the shuffles are sized from ``input_bytes``, the bytes of the largest input, or from
    ``shuffle_partitions``; one of them is required.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(BASE_SETTINGS)
    if master is not None:
        builder = builder.master(master)
        settings["spark.ui.enabled"] = "false"
    else:
        if input_bytes is None and shuffle_partitions is None:
            raise ValueError("a cluster session needs input_bytes or shuffle_partitions to size its shuffles")
        if input_bytes is not None:
            number = str(initial_partitions(input_bytes))
            settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = number
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Apply the settings that results, state or planning time depend on to a session built elsewhere."""
    for key in NEEDED_SETTINGS:
        spark.conf.set(key, BASE_SETTINGS[key])


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A local session may fall back to a temporary folder; a cluster session may not, because other machines
    could not read what is written there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), "remitlens-scratch")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of a finished query; only what lies below the shared folder can be named."""
    if not path.startswith(f"{shared_root(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and continue from the written table.

    Cuts lineage where several later jobs read the same result; the table outlives lost executors.
    """
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
