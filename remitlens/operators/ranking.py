"""Top-k, numbered rankings and running totals. A limit after a sort runs as a per-partition top-k, without a global sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.session import settle


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, k: int, rank_name: str, *order: Column) -> DataFrame:
    """Number the k best rows; the window sees only those k rows."""
    best = top_k(df, k, *order)
    return best.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def running_totals(df: DataFrame, order: Sequence[Column], totals: Mapping[str, Column], name: str = "ranges") -> DataFrame:
    """Adds to each row the totals over all rows before it in the order; no window spans the whole table.

    Rows are dealt into ranges of the order and written once. Each range is summed within itself, and starts from
    the sum of the ranges before it: there are as many of those as shuffle partitions. Rows that are equal in the order lie in one
    range, so what can repeat without bound is grouped by the caller first. A total of ``F.lit(1)`` numbers the rows from 0.
    """
    dealt = df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range"))
    ranges = settle(df.sparkSession, dealt, name)
    per_range = ranges.groupBy(F.col("_range").alias("_of")).agg(*[F.sum(value).alias(f"_in_{key}") for key, value in totals.items()])
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select("_of", *[F.sum(f"_in_{key}").over(earlier).alias(f"_start_{key}") for key in totals])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranges.select("*", *[F.sum(value).over(within).alias(f"_own_{key}") for key, value in totals.items()])
    zero = F.lit(0)
    return inner.join(F.broadcast(starts), F.col("_range") == F.col("_of")).select(
        *[F.col(f"`{column}`") for column in df.columns],
        *[(F.coalesce(f"_own_{key}", zero) + F.coalesce(f"_start_{key}", zero)).alias(key) for key in totals],
    )
