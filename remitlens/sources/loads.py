"""Loads of files into tables: read with a schema, check required fields, write, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from remitlens.sources.readers import JSON_FILES, enforce_required, read_csv, read_json
from remitlens.sources.writers import add_rows, publish_table

TRUNCATE, APPEND = "truncate", "append"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, *, kind: str = "json", glob: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Files below a prefix: JSON documents (or lines), or CSV with a header."""
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind == "json":
        return read_json(spark, path, schema, multi_line=multi_line, glob=glob or JSON_FILES)
    raise ValueError(f"unknown kind of files: {kind}")


def load(files: DataFrame, table: str, required: Sequence[str], mode: str = TRUNCATE) -> int:
    """Write rows into a catalog table and return how many it holds, as the write counted them.

    A row without a required field fails the load, and the table then keeps its former content: ``truncate`` replaces
    the rows of the table once the new ones are complete, ``append`` adds to them.
    """
    if mode not in (TRUNCATE, APPEND):
        raise ValueError(f"unknown load mode: {mode}")
    checked = enforce_required(files, required)
    return (add_rows if mode == APPEND else publish_table)(checked, table).rows
