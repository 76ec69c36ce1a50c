"""Histograms, box statistics and null profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numeric import count_where, fixed_ratio, round_half_up
from remitlens.operators.selection import quantiles


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the minimum and the maximum; the last bin includes the maximum.

    Both bounds enter as one scalar subquery, so the data is read twice but never joined.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    bounds = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")).alias("bounds"))
    placed = values.select("v", bounds.scalar().alias("bounds")).select("v", "bounds.low", "bounds.high")
    span = F.col("high") - F.col("low")
    position = F.floor((F.col("v") - F.col("low")) / span * bins)
    bin_number = F.when(span == 0, F.lit(0).cast("bigint")).otherwise(
        F.least(position, F.lit(bins - 1).cast("bigint"))
    )
    counted = placed.groupBy(bin_number.alias("bin"), "low", "high").agg(F.count(F.lit(1)).alias("rows"))
    width = (F.col("high") - F.col("low")) / bins
    return counted.select(
        "bin",
        round_half_up(F.col("low") + F.col("bin") * width, 4).alias("bin_from"),
        round_half_up(F.col("low") + (F.col("bin") + 1) * width, 4).alias("bin_to"),
        "rows",
    )


def box_statistics(df: DataFrame, group: str, column: str, places: int = 4) -> DataFrame:
    """Quartiles by linear interpolation, extremes and 1.5 IQR fences per group.

    Values are rounded to ``places`` decimals and counted first, so the percentile works on distinct values with
    frequencies: its state is bounded by the range of the column in such steps, not by the number of rows.
    """
    rounded = round_half_up(F.col(column).cast("double"), places).alias(column)
    counted = df.where(F.col(column).isNotNull()).select(group, rounded).groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))
    quartiles = F.percentile(F.col(column), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    stats = counted.groupBy(group).agg(
        F.sum("n").alias("rows"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
        quartiles.alias("q"),
    )
    q1, median, q3 = (F.col("q")[i] for i in range(3))
    reach = (q3 - q1) * 1.5
    return stats.select(
        group,
        "rows",
        "lowest",
        round_half_up(q1, 4).alias("q1"),
        round_half_up(median, 4).alias("median"),
        round_half_up(q3, 4).alias("q3"),
        "highest",
        round_half_up(q1 - reach, 4).alias("lower_fence"),
        round_half_up(q3 + reach, 4).alias("upper_fence"),
    )


def exact_box_statistics(df: DataFrame, group: str, column: str) -> DataFrame:
    """``box_statistics`` of a column of any precision, nothing rounded: quartiles are selected by counting in ranges."""
    quartiles = quantiles(df, group, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumnRenamed(group, "_group")
    values = df.select(group, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    extremes = values.groupBy(group).agg(F.min("_v").alias("lowest"), F.max("_v").alias("highest"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return extremes.join(quartiles, F.col(group).eqNullSafe(F.col("_group"))).select(
        group, F.col("n").alias("rows"), "lowest", "q1", "median", "q3", "highest",
        (F.col("q1") - reach).alias("lower_fence"), (F.col("q3") + reach).alias("upper_fence"),
    )


def null_profile(df: DataFrame, source: str) -> DataFrame:
    """Row count, column count and the mean share of NULLs over all columns, in percent."""
    width = len(df.columns)
    nulls = sum((count_where(F.col(f"`{name}`").isNull()) for name in df.columns), F.lit(0).cast("bigint"))
    cells = F.count(F.lit(1)) * width
    return df.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(width).cast("bigint").alias("columns"),
        fixed_ratio(nulls * 100, cells, 2).alias("null_pct"),
    )
