"""File readers with fixed schemas. Malformed records fail the job; nothing is inferred."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Instants keep their microseconds and their offset in text form.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

JSON_FILES = "*.{json,json.gz}"


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = True, glob: str = JSON_FILES
) -> DataFrame:
    """All JSON files under a prefix, at any depth, plain or compressed by gzip.

    ``multi_line`` reads each file as one document, as an indented array of records needs. Without it every line
    is a record or an array of records, and large plain files are split over tasks.
    """
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line that is skipped; blanks around values are kept."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", True)
        .csv(path)
    )


def read_optional(spark: SparkSession, schema: T.StructType, read: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``read``, or an empty table of the schema when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def enforce_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail the job at the first row without a required value; file readers do not check this themselves."""

    def checked(name: str) -> Column:
        return F.coalesce(F.col(name), F.raise_error(F.lit(f"required field {name} is missing"))).alias(name)

    return df.select(*[checked(name) if name in required else F.col(f"`{name}`") for name in df.columns])


def with_audit_columns(df: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Add a record id and the load time; one time for the whole load, fixed before the job starts."""
    moment = F.lit(loaded_at or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    return df.withColumns(
        {"_airbyte_ab_id": F.uuid(), "_airbyte_emitted_at": moment, "_airbyte_normalized_at": moment}
    )


def as_json(df: DataFrame) -> Column:
    """Each row as one JSON document."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]), JSON_TIMES)


def _packer(records: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held.extend(batch.column(0).to_pylist())
            full = len(held) - len(held) % records
            arrays = [f"[{','.join(held[at : at + records])}]" for at in range(0, full, records)]
            held = held[full:]
            yield pa.RecordBatch.from_arrays([pa.array(arrays, pa.string())], names=["value"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([f"[{','.join(held)}]"])], names=["value"])

    return pack


def as_json_arrays(df: DataFrame, records_per_array: int) -> DataFrame:
    """Pack rows into JSON arrays of at most ``records_per_array`` records, one array per output row.

    Rows are packed where they are: each task joins the documents of its partition as they pass, so nothing is shuffled, and no
    more than an array and a batch of rows is held. Only the last array of a partition is shorter.
    """
    return df.select(as_json(df).alias("value")).mapInArrow(_packer(records_per_array), "value string")
