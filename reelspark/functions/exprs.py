"""Parsing, null handling and rounding as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: every character that counts as whitespace when text is stripped or split.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a pattern; the property class is far faster than a list.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Strip all surrounding whitespace, not only spaces as ``trim`` does."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c.cast("string")) == "")


def has_value(df: DataFrame, name: str) -> Column:
    """Not null and, for text columns, not empty."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.isNotNull() & (c != "")
    return c.isNotNull()


def to_number(c: Column) -> Column:
    """Text to double; unparseable text and NaN become null."""
    parsed = c.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def to_whole(c: Column) -> Column:
    """Number or text to a whole number, truncated toward zero."""
    return to_number(c).try_cast("bigint")


def to_timestamp(c: Column) -> Column:
    """Text to a zone-free timestamp; anything unparseable becomes null."""
    return c.try_cast("timestamp_ntz")


def to_date(c: Column) -> Column:
    return to_timestamp(c).cast("date")


def whole_seconds(c: Column) -> Column:
    """Drop the fraction of a second without leaving the zone-free type."""
    fraction = F.extract(F.lit("SECOND"), c) % 1
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour periods between two timestamps."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def round_even(c: Column, digits: int) -> Column:
    """Round half to even on the scaled value, as dataframe libraries do."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def text_of(c: Column) -> Column:
    """Value as it is shown in messages; a missing value shows as ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def is_watch() -> Column:
    return F.col("event_type") == "video_watch"
