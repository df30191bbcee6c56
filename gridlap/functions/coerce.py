"""Null-safe coercion and scalar rules as column expressions. Bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Text or number to double: outer space is ignored, NaN and anything else unreadable is null."""
    s = F.trim(c.cast("string"))
    # A trailing d or f after a digit is a Java suffix, not a number.
    number = F.when(~s.rlike("(?i)[0-9.][df]$"), s).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_integer(c: Column) -> Column:
    """To long by way of double, so that '1.0' is 1."""
    return to_number(c).try_cast("bigint")


def to_utc(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def to_seconds(c: Column) -> Column:
    """'[N days ]HH:MM:SS[.fff]' to seconds."""
    s = F.trim(c.cast("string"))
    part = lambda i: F.coalesce(F.regexp_extract(s, r"^(?:(\d+) days? )?(\d+):(\d{2}):(\d{2}(?:\.\d+)?)$", i).try_cast("double"), F.lit(0.0))
    return F.when(s.rlike(r"^(\d+ days? )?\d+:\d{2}:\d{2}(\.\d+)?$"), part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4))


def clean_text(c: Column, default: str = "Unknown") -> Column:
    """Trimmed; 'nan', empty and null become the default."""
    s = F.trim(c.cast("string"))
    return F.when(s.isNull() | s.isin("nan", ""), F.lit(default)).otherwise(s)


def one_of(c: Column, allowed: Sequence[str], default: str = "UNKNOWN") -> Column:
    s = F.upper(F.trim(c.cast("string")))
    return F.when(s.isin(*allowed), s).otherwise(F.lit(default))


def to_bool(c: Column) -> Column:
    s = F.lower(c.cast("string"))
    return F.when(s.isin("true", "1"), True).when(s.isin("false", "0"), False)


def is_lapped(c: Column) -> Column:
    return F.coalesce(F.upper(c.cast("string")).contains("LAP"), F.lit(False))


def flag(condition: Column) -> Column:
    """0 or 1; null counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip(c: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Within the bounds; null stays null."""
    out = c
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(c.isNotNull(), out)


def in_range_or_null(c: Column, low: float, high: float) -> Column:
    return c.between(low, high) | c.isNull()


def null_outside(c: Column, low: float | None = None, high: float | None = None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside &= c >= low
    if high is not None:
        inside &= c <= high
    return F.when(inside, c)


def right_closed_bin(c: Column, width: int, top: int) -> Column:
    """The left edge of the bin (a, a + width] in (0, top]; null outside."""
    return F.when((c > 0) & (c <= top), ((F.ceil(c / width) - 1) * width).cast("long"))
