"""Versioned parquet data: a manifest, committed last, names the folders that make up each snapshot.

Writers put rows into fresh folders that nobody reads yet, and then commit the next manifest, a small file that appears in one
step under its number. Readers follow the newest manifest. So whatever is cut short leaves the former snapshot as it is, and
of two writers that build on the same snapshot one loses and starts from the new one.

    root/data/<folder>/part-*.parquet
    root/manifests/<number>.json        {"folders": [...], "marks": {...}}

Marks are numbers that are committed with the data, such as the last batch of a stream. Folders are immutable; ``expire`` removes
those that only old manifests name. A manifest lists folders, not files; compaction keeps it short.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.sources import filesystem
from remitlens.sources.observed import RowCounts


Part = DataFrame | Callable[[str], DataFrame]


class Conflict(RuntimeError):
    """Another writer has committed the next snapshot."""


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    folders: tuple[str, ...] = ()
    marks: Mapping[str, int] = field(default_factory=dict)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int | None:
    """Runs a write and returns its rows, as counted by the write itself; None if it did not report them."""
    with RowCounts(df.sparkSession) as counts:
        write(counts.observed(df, "written"))
        return counts.rows("written")


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root.rstrip("/")

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"

    def _numbers(self) -> list[int]:
        names = filesystem.names_in(self._spark, f"{self.root}/manifests")
        return [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith(".")]

    def snapshot(self, number: int) -> Snapshot:
        found = json.loads(filesystem.read_bytes(self._spark, self._manifest(number)))
        return Snapshot(number, tuple(found["folders"]), found["marks"])

    def latest(self) -> Snapshot:
        """The newest committed snapshot; number 0 and no folders if there is none."""
        numbers = self._numbers()
        return self.snapshot(max(numbers)) if numbers else Snapshot()

    def read(self, schema: T.StructType, snapshot: Snapshot | None = None, part: str | None = None) -> DataFrame:
        """The rows of a snapshot, the newest one if none is named; of stores with several tables, those of one of them."""
        found = self.latest() if snapshot is None else snapshot
        if not found.folders:
            return self._spark.createDataFrame([], schema)
        if part is None:
            return self._spark.read.schema(schema).parquet(*[f"{self.root}/data/{name}" for name in found.folders])
        # Each folder may be partitioned below its part.
        parts = [self._spark.read.schema(schema).parquet(f"{self.root}/data/{name}/{part}") for name in found.folders]
        return reduce(DataFrame.unionByName, parts)

    def stage(self, df: DataFrame) -> tuple[str, int]:
        """Writes rows into a fresh folder, which no snapshot names yet; returns the folder and the rows in it."""
        name = uuid.uuid4().hex
        path = f"{self.root}/data/{name}"
        rows = counted_write(df, lambda out: out.write.mode("errorifexists").parquet(path))
        return name, self._spark.read.schema(df.schema).parquet(path).count() if rows is None else rows

    def commit(self, base: Snapshot, folders: tuple[str, ...], marks: Mapping[str, int] | None = None) -> Snapshot:
        """The next snapshot after ``base``; fails if there is one already."""
        following = Snapshot(base.number + 1, tuple(folders), dict(base.marks if marks is None else marks))
        content = json.dumps({"folders": following.folders, "marks": following.marks}).encode()
        if not filesystem.create(self._spark, self._manifest(following.number), content):
            raise Conflict(f"snapshot {following.number} of {self.root} was committed by another writer")
        return following

    def replace(self, df: DataFrame) -> tuple[Snapshot, int]:
        """A snapshot of these rows alone."""
        folder, rows = self.stage(df)
        while True:
            try:
                return self.commit(self.latest(), (folder,)), rows
            except Conflict:
                continue

    def append_batch(self, df: DataFrame, writer: str, batch: int) -> Snapshot:
        """Adds a batch of a stream, once: a repeated batch of the same writer changes nothing.

        ``SEQUENCE`` in the marks counts the batches of all writers; rows get it as their ``version``.
        """
        while True:
            base = self.latest()
            if base.marks.get(writer, -1) >= batch:
                # Computed all the same: the state of a streaming aggregate is committed by computing its batch.
                df.write.format("noop").mode("overwrite").save()
                return base
            sequence = base.marks.get(SEQUENCE, 0) + 1
            folder, rows = self.stage(df.withColumn(VERSION, F.lit(sequence).cast("long")))
            folders = (*base.folders, folder) if rows else base.folders
            try:
                return self.commit(base, folders, {**base.marks, SEQUENCE: sequence, writer: batch})
            except Conflict:
                filesystem.remove(self._spark, f"{self.root}/data/{folder}")

    def _stage_parts(self, parts: Mapping[str, Part], partitioned: Mapping[str, str]) -> str:
        name = uuid.uuid4().hex
        for part, made in parts.items():
            df = made(f"{self.root}/data/{name}") if callable(made) else made
            writer = df.write.mode("errorifexists")
            if part in partitioned:
                writer = df.repartition(partitioned[part]).write.mode("errorifexists").partitionBy(partitioned[part])
            writer.parquet(f"{self.root}/data/{name}/{part}")
        return name

    def append_parts(
        self, batch: DataFrame, parts: Callable[[Snapshot], Mapping[str, Part]], writer: str, number: int, partitioned: Mapping[str, str]
    ) -> Snapshot:
        """``append_batch`` for several tables that become visible together; they are made from the snapshot they are added to.
        They are written in their order, and one that is made from those before it is a function of the folder they lie in."""
        while True:
            base = self.latest()
            if base.marks.get(writer, -1) >= number:
                batch.write.format("noop").mode("overwrite").save()
                return base
            folder = self._stage_parts(parts(base), partitioned)
            try:
                return self.commit(base, (*base.folders, folder), {**base.marks, writer: number})
            except Conflict:
                filesystem.remove(self._spark, f"{self.root}/data/{folder}")

    def compact_parts(
        self, folds: Mapping[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]], partitioned: Mapping[str, str]
    ) -> Snapshot:
        """``compact`` for several tables."""
        base = self.latest()
        if len(base.folders) < 2:
            return base
        parts = {part: fold(self.read(schema, base, part)) for part, (schema, fold) in folds.items()}
        return self._swap(base, self._stage_parts(parts, partitioned))

    def compact(self, schema: T.StructType, fold: Callable[[DataFrame], DataFrame]) -> Snapshot:
        """Folds the newest snapshot's folders into one. Batches that arrive meanwhile are kept beside it."""
        base = self.latest()
        if len(base.folders) < 2:
            return base
        folder, _ = self.stage(fold(self.read(schema, base)))
        return self._swap(base, folder)

    def _swap(self, base: Snapshot, folder: str) -> Snapshot:
        """A snapshot with one folder in place of those of ``base``."""
        while True:
            now = self.latest()
            if not set(base.folders) <= set(now.folders):  # another compaction was faster
                filesystem.remove(self._spark, f"{self.root}/data/{folder}")
                return now
            try:
                return self.commit(now, (folder, *[name for name in now.folders if name not in base.folders]))
            except Conflict:
                continue

    def expire(self, keep: int = 2, orphan_hours: float | None = None) -> None:
        """Removes all but the newest ``keep`` manifests, and the folders that only removed ones name. With ``orphan_hours`` also
        folders that no manifest names and that are older than any write can last."""
        numbers = sorted(self._numbers())
        old, kept = numbers[: -max(keep, 1)], numbers[-max(keep, 1) :]
        needed = {name for number in kept for name in self.snapshot(number).folders}
        gone = {name for number in old for name in self.snapshot(number).folders} - needed
        # Manifests first: none may name a folder that is gone.
        for number in old:
            filesystem.remove(self._spark, self._manifest(number))
        if orphan_hours is not None:
            before = time.time() - 3600 * orphan_hours
            for name in filesystem.names_in(self._spark, f"{self.root}/data"):
                if name not in needed and filesystem.modified(self._spark, f"{self.root}/data/{name}") < before:
                    gone.add(name)
        for name in sorted(gone):
            filesystem.remove(self._spark, f"{self.root}/data/{name}")


VERSION, SEQUENCE = "version", "sequence"
