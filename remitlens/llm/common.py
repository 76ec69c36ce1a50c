"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens import session

#: Rows and bytes of text that a Python worker holds at a time.
ARROW_ROWS = 500
ARROW_BYTES = 8 << 20
CHUNK_BYTES = 2 << 20

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def prepare(spark: SparkSession) -> None:
    """Session settings of the text operators: small Arrow batches, so that long texts don't fill a worker."""
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read again: later jobs and lost executors don't compute it anew."""
    return session.settle(df.sparkSession, df, name)


def same(left: Column, right: Column) -> Column:
    """Equality in which NULL equals NULL; Spark hashes and sorts on it like on plain equality."""
    return left.eqNullSafe(right)


def pieces_for(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    values = batch.column(batch.schema.get_field_index(column))
    return values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()


def grouped(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` bytes together; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixer (two multiply-shift rounds) applied to an array."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def random_table(entries: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers from a rule, the same in every process."""
    return mix(np.arange(entries, dtype=np.uint64), seed)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, np.uint64(base & 0xFFFFFFFFFFFFFFFF))
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)
