"""Exact, order-independent arithmetic for money, scores and rates.

Sums of floating-point cents depend on the order in which partitions are merged, so a re-run after a lost
executor can change the last digit. Columns that carry two decimals are therefore summed as whole hundredths in
BIGINT, and averages and rates are rounded by integer division. BIGINT accumulators stay inside whole-stage
code generation and cost the same as DOUBLE ones. Nothing is clamped: a value that has no such number (too large, NaN,
infinite) fails the job, and a sum that overflows raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BIGINT ends here.
_LIMIT = 2.0**63


def _loud(value: Column, size: Column, limit: float) -> Column:
    """``value``, or a failed job if ``size`` reaches the limit; NaN compares above every limit. NULL stays NULL."""
    problem = F.concat(F.lit("no exact number for the value "), size.cast("string"))
    return F.when(size >= limit, F.raise_error(problem)).otherwise(value)


def as_decimal(value: Column) -> Column:
    """The decimal text of a double, rounded half up to six decimals; NaN, infinity and 1e18 or more fail the job."""
    return _loud(value, F.abs(value), 1.0e18).cast("decimal(24,6)")


def round_half_up(value: Column, places: int) -> Column:
    """Round a double half away from zero on its first six decimals, and return a double.

    Equals ``CAST(ROUND(CAST(value AS DECIMAL(24,6)), places) AS DOUBLE)`` for every value: the decimal text of the
    double is rounded half up to six decimals, then to ``places``. NULL stays NULL; NaN, infinity and values of 1e18
    or more fail the job.
    """
    if not 0 <= places <= 5:
        raise ValueError("places must be between 0 and 5")
    return F.round(as_decimal(value), places).cast("double")


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """BIGINT division rounded half up, for values that are not negative; NULL when the denominator is 0 or NULL."""
    den = F.nullif(denominator, F.lit(0))
    return F.call_function("div", numerator * 2 + den, den * 2)


def half_away_div(numerator: Column, denominator: Column) -> Column:
    """BIGINT division rounded half away from zero, for amounts of either sign."""
    size = half_up_div(F.abs(numerator), denominator)
    return F.when(numerator < 0, -size).otherwise(size)


def fixed_ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """numerator / denominator for BIGINT inputs of either sign, rounded exactly to ``places`` decimals, as a double."""
    return half_away_div(numerator * 10**places, denominator) / float(10**places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for BIGINT counts; NULL for an empty whole."""
    return half_up_div(part * 10 ** (places + 2), whole) / float(10**places)


def scaled(value: Column, places: int = 2) -> Column:
    """The BIGINT number of 10**-places units in a double that already carries at most ``places`` decimals."""
    units = value * float(10**places) + 0.5
    return _loud(F.floor(units), F.abs(units), _LIMIT)


def exact_sum(value: Column, places: int = 2) -> Column:
    """Sum of a column that carries at most ``places`` decimals; independent of row order."""
    return F.sum(scaled(value, places)) / float(10**places)


def exact_mean(value: Column, places: int = 2, result_places: int | None = None) -> Column:
    """Mean of a column that carries at most ``places`` decimals, rounded exactly to ``result_places``."""
    out = places if result_places is None else result_places
    if out > places:
        raise ValueError("a mean cannot be given more decimals than its values carry")
    units = F.count(value) * 10 ** (places - out) if out < places else F.count(value)
    return half_away_div(F.sum(scaled(value, places)), units) / float(10**out)


def mean_of_counts(value: Column, places: int = 2) -> Column:
    """Mean of a BIGINT column rounded exactly to ``places`` decimals."""
    return fixed_ratio(F.sum(value), F.count(value), places)


def micro_sum(value: Column) -> Column:
    """Order-independent sum, at six decimals, of raw doubles that were never rounded; as a double.

    Decimals carry amounts of any size below 1e18, which hundredths of millionths in BIGINT would not.
    """
    return F.sum(as_decimal(value)).cast("double")


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition holds."""
    return F.count(F.when(condition, F.lit(1)))
