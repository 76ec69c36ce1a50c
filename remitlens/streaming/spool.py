"""Pulling messages from a spool: a topic as numbered segments of text, a streaming source with bounded pulls, and stop rules.

    spool/000000000003-100.txt          segment 3 with 100 messages, one per line
    spool/_subscriptions/<name>.json    how far the pulls of a subscription have been planned

Messages are numbered over all segments, so an offset is one number. Segments never change and appear by a rename. A pull takes
at most ``max_messages`` after the one before; only their number passes the driver, the messages are read by tasks, each a slice
of a segment. Offsets are committed in the checkpoint of the query, after its write: a crash repeats a pull and loses none.
"""

from __future__ import annotations

import io
import itertools
import json
import threading
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from remitlens.sources import filesystem
from remitlens.sources.readers import as_json

#: Messages of a segment and of a task's slice, and lines that a task holds at a time.
SEGMENT, SLICE, LINES = 100_000, 20_000, 5_000
_SUBSCRIPTIONS = "_subscriptions"


def _length(name: str) -> int:
    return int(name.removesuffix(".txt").split("-")[1])


def _segment_names(names: Sequence[str]) -> list[str]:
    return sorted(name for name in names if name.endswith(".txt") and name[0].isdigit())


def publish_to_spool(df: DataFrame, spool: str, segment: int = SEGMENT) -> int:
    """Append rows as JSON messages and return their number. Tasks write the segments; the driver names them. A spool has one publisher
    at a time; of two, one fails."""
    spark, draft = df.sparkSession, f"{spool}/.draft-{uuid.uuid4().hex}"
    df.select(as_json(df).alias("value")).write.option("maxRecordsPerFile", segment).text(draft)
    per_file = spark.read.text(draft).groupBy(F.col("_metadata.file_name").alias("file")).count().orderBy("file").collect()
    following = len(_segment_names(filesystem.names_in(spark, spool)))
    for number, row in enumerate(per_file, following):
        filesystem.rename(spark, f"{draft}/{row['file']}", f"{spool}/{number:012d}-{row['count']}.txt")
    filesystem.remove(spark, draft)
    return sum(row["count"] for row in per_file)


class _Slice(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class SpoolReader(DataSourceStreamReader):
    """Offsets and slices on the driver; lines in tasks."""

    def __init__(self, options: dict):
        options = {key.lower(): value for key, value in options.items()}
        self._files, self._root = fs.FileSystem.from_uri(_as_uri(options["path"]))
        self._uri, self._most = _as_uri(options["path"]), int(options["maxmessages"])
        self._position_file = f"{self._root}/{_SUBSCRIPTIONS}/{options['subscription']}.json"
        self._planned = self._begin = self._read_position()
        self._expected = int(options["expected"]) if "expected" in options else None

    def _read_position(self) -> int:
        if self._files.get_file_info(self._position_file).type == fs.FileType.NotFound:
            return 0
        with self._files.open_input_stream(self._position_file) as stream:
            return json.loads(stream.read())["message"]

    def _write_position(self, message: int) -> None:
        self._files.create_dir(self._position_file.rsplit("/", 1)[0], recursive=True)
        draft = f"{self._position_file}.{uuid.uuid4().hex}"
        with self._files.open_output_stream(draft) as stream:
            stream.write(json.dumps({"message": message}).encode())
        self._files.move(draft, self._position_file)

    def _segments(self) -> list[tuple[str, int, int]]:
        """Name, first message and end of each segment."""
        found = self._files.get_file_info(fs.FileSelector(self._root, allow_not_found=True))
        out, start = [], 0
        for name in _segment_names([info.base_name for info in found if info.type == fs.FileType.File]):
            out.append((name, start, start + _length(name)))
            start = out[-1][2]
        return out

    def initialOffset(self) -> dict:
        # A new checkpoint starts from the first message, whatever the subscription did before.
        self._planned = self._begin = 0
        return {"message": 0}

    def latestOffset(self) -> dict:
        """The end of the next pull; the last end again if this run has planned the expected messages."""
        if self._expected is not None and self._planned - self._begin >= self._expected:
            return {"message": self._planned}
        segments = self._segments()
        available = segments[-1][2] if segments else 0
        self._planned = max(self._planned, min(self._planned + self._most, available))
        return {"message": self._planned}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, last = start["message"], end["message"]
        if last < first:
            raise ValueError(f"the position of the subscription was lost: it is at {last}, the query is at {first}")
        # Before the pull is made: a restarted reader must not plan behind what the checkpoint knows.
        self._planned, self._begin = last, min(self._begin, first)
        self._write_position(last)
        slices = []
        for name, low, high in self._segments():
            begin, stop = max(first, low), min(last, high)
            slices += [_Slice(name, at - low, min(at + SLICE, stop) - low) for at in range(begin, stop, SLICE)]
        return slices or [_Slice("", 0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, root = fs.FileSystem.from_uri(self._uri)
        with files.open_input_stream(f"{root}/{partition.path}") as stream:
            text = io.TextIOWrapper(stream, encoding="utf-8", newline="\n")
            wanted = itertools.islice(text, partition.start, partition.stop)
            while lines := [line.rstrip("\n") for line in itertools.islice(wanted, LINES)]:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


def _as_uri(path: str) -> str:
    """Hadoop writes local paths as file:/x; Arrow wants file:///x."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return path if "://" in path else f"file://{path}"


class SpoolSource(DataSource):
    """``spool``: options path, subscription, maxMessages (of a pull) and expected (of a run, if bounded); a column ``value``."""

    @classmethod
    def name(cls) -> str:
        return "spool"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> SpoolReader:
        return SpoolReader(dict(self.options))


def register_spool(spark: SparkSession) -> None:
    spark.dataSource.register(SpoolSource)


def spool_options(path: str, subscription: str, max_messages: int = 100, expected: int | None = None) -> dict[str, str]:
    """Options of the source. With ``expected`` a run plans no pull after the one that reaches that many messages."""
    options = {"path": path, "subscription": subscription, "maxMessages": str(max_messages)}
    return options if expected is None else {**options, "expected": str(expected)}


class StopRules(StreamingQueryListener):
    """Tells when a query has taken the expected number of messages, or has pulled in vain several times in a row."""

    def __init__(self, expected: int | None, empty_pulls: int):
        self._expected, self._most_empty = expected, empty_pulls
        self.query_id: str | None = None
        self.taken = self.empty = 0
        self.reached = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def _pulled(self, messages: int) -> None:
        self.taken += messages
        self.empty = 0 if messages else self.empty + 1
        if (self._expected is not None and self.taken >= self._expected) or self.empty >= self._most_empty:
            self.reached.set()

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id:
            self._pulled(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query_id:
            self._pulled(0)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.reached.set()


def pull_until(
    spark: SparkSession, writer: DataStreamWriter, expected: int | None, empty_pulls: int = 5, pause: str = "2 seconds"
) -> int:
    """Run a query until it has taken the expected number of messages, or that many pulls in a row were empty; returns the
    messages taken. A failed query raises here. What a pull took beyond the expected number is kept. Spark reports a pull a
    little after it has ended; the source's own ``expected`` keeps it from planning another one meanwhile."""
    rules, interval = StopRules(expected, empty_pulls), "spark.sql.streaming.noDataProgressEventInterval"
    if expected is not None and expected <= 0:
        return 0
    before = spark.conf.get(interval, None)
    spark.streams.addListener(rules)
    try:
        spark.conf.set(interval, "0")  # every empty pull is reported
        query = writer.trigger(processingTime=pause).start()
        rules.query_id = str(query.id)
        if before is None:
            spark.conf.unset(interval)
        else:
            spark.conf.set(interval, before)
        while not rules.reached.wait(0.2) and query.isActive:
            pass
        query.stop()
        query.awaitTermination()
    finally:
        spark.streams.removeListener(rules)
    return rules.taken
