"""Batch deduplication by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest in the order of all other columns, NULLs first.

    The winner is a struct minimum: a sort-based aggregate on each side of one shuffle, combined on the map side. A key
    that owns a large share of the rows therefore costs one row per task, where a window would sort all its rows in a
    single task.
    """
    rest = [name for name in df.columns if name != key]
    packed = F.struct(*[F.col(f"`{name}`") for name in rest])
    winners = df.groupBy(key).agg(F.min(packed).alias("_row"))
    return winners.select(*[F.col(key) if name == key else F.col(f"_row.`{name}`") for name in df.columns])
