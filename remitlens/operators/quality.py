"""Data-quality checks. Each returns its findings as rows; none collects data to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.functions.numeric import count_where


def stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def pass_if(condition: Column) -> Column:
    return F.when(condition, F.lit("PASS")).otherwise(F.lit("FAIL"))


def required_field_nulls(table: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """NULL count per required column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[count_where(F.col(name).isNull()).alias(name) for name in required]
    )
    return counts.unpivot("rows", list(required), "column_name", "null_rows").select(
        F.lit(table).alias("table_name"),
        "column_name",
        "rows",
        "null_rows",
        pass_if(F.col("null_rows") == 0).alias("status"),
    )


def row_count(table: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table_name"), "rows")


def known_counts(spark: SparkSession, counts: Mapping[str, int | None]) -> DataFrame:
    """table_name and rows of tables whose counts are known already; as many rows as tables."""
    return spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")


def non_empty_check(
    tables: Mapping[str, DataFrame | None], layers: Mapping[str, str], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows per expected table with OK / EMPTY / MISSING; a table that does not exist is passed as None.

    ``counted`` has rows that are known, from the writes of the tables; only the others are read to count them.
    """
    spark = next(df for df in tables.values() if df is not None).sparkSession
    known = {name: (counted or {}).get(name) for name, df in tables.items() if df is None or name in (counted or {})}
    parts = [row_count(name, df) for name, df in tables.items() if name not in known]
    if known:
        parts.append(known_counts(spark, known))
    layer = F.create_map(*[F.lit(text) for name in tables for text in (name, layers[name])])
    status = (
        F.when(F.col("rows").isNull(), F.lit("MISSING")).when(F.col("rows") > 0, F.lit("OK")).otherwise(F.lit("EMPTY"))
    )
    return stacked(parts).select(layer[F.col("table_name")].alias("layer"), "table_name", "rows", status.alias("status"))


def catalog_tables(spark: SparkSession, database: str, expected: Sequence[str]) -> dict[str, DataFrame | None]:
    """The expected tables that a database lists; those it lacks are None."""
    # The statement reads names only; the catalog's own listing looks up every table.
    listed = {row["tableName"] for row in spark.sql(f"SHOW TABLES IN {database}").collect()}
    return {name: spark.table(f"{database}.{name}") if name in listed else None for name in expected}


def minimum_rows(tables: Mapping[str, DataFrame], minimum: Mapping[str, int]) -> DataFrame:
    parts = [
        row_count(name, df).withColumn("minimum", F.lit(minimum[name]).cast("bigint")) for name, df in tables.items()
    ]
    return stacked(parts).withColumn("status", pass_if(F.col("rows") >= F.col("minimum")))


def duplicate_keys(table: str, df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once."""
    return (
        df.groupBy(F.col(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.lit(table).alias("table_name"), "key_value", "copies")
    )


def orphan_keys(table: str, child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the child that the parent lacks. Both sides are reduced to distinct keys before the join,
    so a hot key cannot skew it."""
    return (
        child.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .join(parent.select(key).distinct(), key, "left_anti")
        .select(F.lit(table).alias("table_name"), key)
    )


def column_metadata(table: str, df: DataFrame) -> DataFrame:
    """Column names and types with the number of rows that carry a value."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in df.columns])
    described = counts.unpivot([], list(df.columns), "column_name", "filled_rows")
    kind = F.create_map(*[F.lit(text) for item in types.items() for text in item])
    return described.select(
        F.lit(table).alias("table_name"), "column_name", kind[F.col("column_name")].alias("data_type"), "filled_rows"
    )


def expected_columns(table: str, df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Which expected columns a loaded table lacks, next to its row count."""
    missing = [name for name in expected if name not in df.columns]
    return row_count(table, df).select(
        "table_name",
        "rows",
        F.lit(len(expected)).cast("bigint").alias("expected_columns"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        pass_if(F.lit(not missing)).alias("status"),
    )


def landing_files(prefix: str, df: DataFrame) -> DataFrame:
    """Files and records behind a landing prefix."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.lit(prefix).alias("prefix"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("records"),
    ).withColumn("status", pass_if(F.col("files") > 0))


def domain_coverage(fraud_mart: DataFrame) -> DataFrame:
    """Users of the fraud mart, and how many of them each domain knows."""
    return fraud_mart.agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count("total_calls").alias("with_calls"),
        F.count("total_transfers").alias("with_transfers"),
        F.count("support_tickets").alias("with_tickets"),
    )
