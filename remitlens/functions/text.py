"""Text cleaning and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.functions.numeric import round_half_up

# Fixed value: the characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(value: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks.

    Trimming a character set is several times dearer than trimming blanks, so it only runs on values that, without
    blanks, still do not start and end with a printable ASCII character.
    """
    inner = F.trim(value)
    ends = (F.ascii(inner), F.ascii(F.right(inner, F.lit(1))))
    plain = ends[0].between(0x21, 0x7E) & ends[1].between(0x21, 0x7E)
    return F.when(plain, inner).otherwise(F.btrim(value, F.lit(WHITE_SPACE)))


def clean_lower(value: Column) -> Column:
    return F.lower(strip_space(value))


def clean_upper(value: Column) -> Column:
    return F.upper(strip_space(value))


def corridor_name(sender: Column, receiver: Column) -> Column:
    """Route key; NULL when either end is unknown."""
    return F.concat(sender, F.lit(" -> "), receiver)


def raw_corridor_label(sender: Column, receiver: Column) -> Column:
    """Route label of the landing data, which is neither trimmed nor upper-cased."""
    return F.concat(sender, F.lit(" → "), receiver)


def _fixed(value: Column, places: int) -> Column:
    return round_half_up(value, places).cast(f"decimal(24,{places})").cast("string")


def currency_label(value: Column) -> Column:
    """Short dollar label: millions with two decimals, thousands with one or none, else whole dollars."""
    return (
        F.when(value >= 1_000_000, F.concat(F.lit("$"), _fixed(value / 1_000_000, 2), F.lit("M")))
        .when(value >= 100_000, F.concat(F.lit("$"), _fixed(value / 1_000, 0), F.lit("K")))
        .when(value >= 1_000, F.concat(F.lit("$"), _fixed(value / 1_000, 1), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), F.format_number(round_half_up(value, 0).cast("bigint"), 0)))
    )


def percent_label(value: Column) -> Column:
    """A percentage with one decimal and a percent sign."""
    return F.concat(_fixed(value, 1), F.lit("%"))
