"""Row filters and previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "ALL"


def keep_selected(df: DataFrame, column: str, selected: Sequence[str]) -> DataFrame:
    """Keep rows whose value is in the selection; an empty selection keeps everything."""
    return df.where(F.col(column).isin(*selected)) if selected else df


def keep_choice(df: DataFrame, column: str, choice: str) -> DataFrame:
    """Keep rows with the chosen value; ``ALL`` keeps everything."""
    return df if choice == ALL else df.where(F.col(column) == choice)


def filter_options(df: DataFrame, column: str) -> DataFrame:
    """The distinct known values of a column, sorted."""
    return distinct_options(df, column).orderBy(column)


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    """The distinct known values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def search_all_columns(df: DataFrame, pattern: str) -> DataFrame:
    """Rows in which any column, as text, contains a match of the pattern, ignoring case. NULL never matches."""
    needle = F.lit(f"(?i){pattern}")
    hits = [F.coalesce(F.rlike(F.col(f"`{name}`").cast("string"), needle), F.lit(False)) for name in df.columns]
    return df.where(reduce(lambda left, right: left | right, hits))


def preview(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A fixed sample: the first rows by key."""
    return df.orderBy(key).limit(rows)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read columns as numbers; anything missing or unreadable becomes 0."""
    return df.withColumns(
        {name: F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) for name in columns if name in df.columns}
    )


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become 0, in their own type."""
    return df.fillna(0, subset=list(columns))
