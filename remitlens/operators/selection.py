"""The k-th smallest values of groups, by counting in narrowing ranges.

The range of a group's values is cut into ``PARTS`` parts of equal width, the rows of each part are counted, and the values of the part
with the k-th row are the next range, until they are one value. A round is one aggregate that combines on the map side, so a
group of any size is a few thousand counts per task: nothing is sorted, no rows of a group meet, and nothing is rounded. Each
round narrows a range to a four-thousandth at least, so evenly spread values take two or three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from remitlens.session import settle

#: Parts of a range in a round.
PARTS = 4096


def _finite(value: Column) -> Column:
    """The value, or a failed job for NaN and infinities, which have no place in a range."""
    problem = F.concat(F.lit("no place in a range for the value "), value.cast("string"))
    return F.when(F.abs(value) < 1e300, value).when(value.isNotNull(), F.raise_error(problem))


def kth_values(df: DataFrame, group: str, value: str, wanted: Callable[[Column], Column]) -> DataFrame:
    """group, n, k and value: the k-th smallest value, counted from 1, of each group's values that are not NULL.

    ``wanted`` gives the array of k from the number of values n; what is not between 1 and n is left out. A NULL group is a group. Values
    are doubles; whole numbers are exact up to 2**53.
    """
    rows = df.select(F.col(group).alias("_of"), _finite(F.col(value).cast("double")).alias("_v")).where(F.col("_v").isNotNull())
    # Every round reads the two columns again, so what they come from is computed once.
    rows = settle(df.sparkSession, rows, "selection-values")
    first = rows.groupBy("_of").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    ranges = first.withColumn("k", F.explode(F.array_distinct(wanted(F.col("n"))))).where(F.col("k").between(1, F.col("n")))
    ranges = settle(df.sparkSession, ranges.withColumn("below", F.lit(0).cast("bigint")), "selection-ranges")
    found = []
    while True:
        found.append(ranges.where(F.col("low") == F.col("high")))
        ranges = ranges.where(F.col("low") < F.col("high"))
        if ranges.isEmpty():
            break
        ranges = settle(df.sparkSession, _narrowed(rows, ranges), "selection-ranges")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select(F.col("_of").alias(group), "n", "k", F.col("low").alias("value"))


def _narrowed(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each range cut down to the values of its part that has the k-th row."""
    # Equal ranges of different k are counted once.
    distinct = ranges.select("_of", "low", "high", "below").distinct().withColumnRenamed("_of", "_group")
    inside = rows.join(distinct, F.col("_of").eqNullSafe(F.col("_group")) & F.col("_v").between(F.col("low"), F.col("high")))
    part = F.least(F.floor((F.col("_v") - F.col("low")) / (F.col("high") - F.col("low")) * PARTS), F.lit(PARTS - 1))
    counted = inside.groupBy("_of", "low", "high", "below", part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_v").alias("part_low"), F.max("_v").alias("part_high")
    )
    # At most PARTS rows of a range.
    before = Window.partitionBy("_of", "low", "high", "below").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("rows").over(before), F.lit(0))
    parts = counted.select(
        F.col("_of").alias("_group"), F.col("low").alias("_low"), F.col("high").alias("_high"), "rows", "part_low", "part_high", start.alias("start")
    )
    holds = (
        F.col("_of").eqNullSafe(F.col("_group")) & (F.col("low") == F.col("_low")) & (F.col("high") == F.col("_high"))
        & (F.col("k") > F.col("start")) & (F.col("k") <= F.col("start") + F.col("rows"))
    )
    return ranges.join(parts, holds).select(
        "_of", "n", F.col("part_low").alias("low"), F.col("part_high").alias("high"), "k", F.col("start").alias("below")
    )


def quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """group, n and a column for each named share: the value at (n - 1) * share, interpolated between its neighbours."""

    def places(n: Column) -> Column:
        at = [(n - 1) * F.lit(share) for share in shares.values()]
        return F.array(*[f(place).cast("bigint") + 1 for place in at for f in (F.floor, F.ceil)])

    values = kth_values(df, group, value, places)
    by_place = values.groupBy(group, "n").agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("at"))

    def interpolated(share: float) -> Column:
        place = (F.col("n") - 1) * F.lit(share)
        low, high = (F.col("at")[f(place).cast("bigint") + 1] for f in (F.floor, F.ceil))
        part = place - F.floor(place)
        return low * (1 - part) + high * part

    return by_place.select(group, "n", *[interpolated(share).alias(name) for name, share in shares.items()])
