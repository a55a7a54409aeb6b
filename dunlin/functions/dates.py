"""Date and time functions for the text formats met in raw files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_FORMAT = "'['dd/MMM/yyyy:HH:mm:ss Z']'"


def parse_timestamp(text: Column, pattern: str) -> Column:
    """Text to timestamp; text that does not fit the pattern becomes null."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_compact_millis(text: Column) -> Column:
    """A 17-digit ``yyyyMMddHHmmssSSS`` stamp, milliseconds kept."""
    dotted = F.concat(F.substring(text, 1, 14), F.lit("."), F.substring(text, 15, 3))
    return F.try_to_timestamp(dotted, F.lit("yyyyMMddHHmmss.SSS"))


def day_name(day: Column) -> Column:
    """Full English name of the week day."""
    return F.date_format(day, "EEEE")


def iso_day_number(day: Column) -> Column:
    """Week day number with Monday as 1."""
    return F.weekday(day) + 1


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """Midnight of the given calendar day, without a zone."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(year, month, day, zero, zero, F.lit(0))
