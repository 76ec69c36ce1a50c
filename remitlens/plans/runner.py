"""Runs the models layer by layer, writing each result once and building the next layer from the written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from remitlens.plans.models import MODELS
from remitlens.schemas import FACT_TABLES, LAYERS
from remitlens.sources.observed import RowCounts
from remitlens.sources.snapshots import SnapshotStore
from remitlens.sources.writers import Written, publish_table

SaveTable = Callable[[str, DataFrame], Written]
#: Models that are built at a time. Small ones don't fill a cluster, and none of a layer waits for another.
WORKERS = 8


@dataclass(frozen=True)
class ModelRun:
    position: int
    layer: str
    model: str
    rows: int
    status: str


def file_store(root: str) -> SaveTable:
    """Tables as snapshots of parquet folders under a root; a failed model leaves the former snapshot."""

    def save(name: str, df: DataFrame) -> Written:
        store = SnapshotStore(df.sparkSession, f"{root}/{name}")
        snapshot, rows = store.replace(df)
        store.expire()
        return Written(store.read(df.schema, snapshot), rows)

    return save


def catalog_store(database: str, fact_buckets: int | None = None) -> SaveTable:
    """Tables in a catalog database; a failed model leaves the former table. Facts can be bucketed by user, so that every
    mart reads them aligned."""

    def save(name: str, df: DataFrame) -> Written:
        bucket_by = "user_id" if fact_buckets and name in FACT_TABLES else None
        return publish_table(df, f"{database}.{name}", bucket_by, fact_buckets)

    return save


def run_counted(
    raw: Mapping[str, DataFrame], save: SaveTable, workers: int = WORKERS
) -> tuple[dict[str, DataFrame], list[ModelRun], dict[str, int]]:
    """``run_models``, and the rows of the raw tables, as counted by the first job that reads each."""
    spark = next(iter(raw.values())).sparkSession
    with RowCounts(spark) as counts:
        tables, runs = run_models({name: counts.observed(df, name) for name, df in raw.items()}, save, workers)
        known = {name: counts.rows(name) for name in raw}
    return {**tables, **raw}, runs, {name: rows for name, rows in known.items() if rows is not None}


def run_models(
    raw: Mapping[str, DataFrame], save: SaveTable, workers: int = WORKERS
) -> tuple[dict[str, DataFrame], list[ModelRun]]:
    """Build all models, each as soon as its inputs are written; a failed model does not stop the others, but its
    dependents are skipped rather than built from stale tables. Returns the written tables and one record per model, in the
    models' order. Rows are those that the write counted."""
    tables: dict[str, DataFrame] = dict(raw)
    runs: dict[str, ModelRun] = {}
    positions = {name: position for position, name in enumerate(MODELS, 1)}
    waiting = list(MODELS)
    building: dict[Future, str] = {}

    def record(name: str, rows: int, status: str) -> None:
        runs[name] = ModelRun(positions[name], LAYERS[name], name, rows, status)

    def start(pool: ThreadPoolExecutor, names: Iterable[str]) -> None:
        for name in names:
            sources = MODELS[name].inputs
            absent = [source for source in sources if source not in tables and (source in runs or source not in MODELS)]
            if absent:
                record(name, 0, f"SKIPPED: needs {', '.join(absent)}")
            elif all(source in tables for source in sources):
                inputs = [tables[source] for source in sources]
                building[pool.submit(lambda n=name, i=inputs: save(n, MODELS[n].build(*i)))] = name

    with ThreadPoolExecutor(max_workers=workers) as pool:
        while waiting or building:
            start(pool, waiting)
            started = {*building.values(), *runs}
            waiting = [name for name in waiting if name not in started]
            for future in wait(building, return_when=FIRST_COMPLETED).done:
                name = building.pop(future)
                if error := future.exception():
                    record(name, 0, f"FAIL: {error}")
                else:
                    written = future.result()
                    tables[name] = written.table
                    record(name, written.rows, "PASS")
    return tables, sorted(runs.values(), key=lambda run: run.position)


def run_summary(spark: SparkSession, runs: list[ModelRun]) -> DataFrame:
    """One row per model; there are as many rows as models, so building it on the driver is bounded."""
    return spark.createDataFrame(
        [(run.position, run.layer, run.model, run.rows, run.status) for run in runs],
        "position bigint, layer string, model string, rows bigint, status string",
    )
