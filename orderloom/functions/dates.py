"""Date expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import strip

# An ISO date with a time of day, with or without fraction and zone.
ISO_WITH_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})[T ]\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)? ?(Z|UTC|[+-]\d{2}:?\d{2})?$"


def parse_date(text: Column, formats: Sequence[str]) -> Column:
    """Text to date by the first format that fits; null where none does.

    The time of day of an ISO timestamp is dropped first: the day is the one that is
    written, whatever its zone. Texts that lack one of a format's marks are not parsed by it, as
    a failed parse costs an exception.
    """
    trimmed = strip(text)
    timed = F.contains(trimmed, F.lit(":"))
    day = F.when(timed, F.regexp_replace(trimmed, ISO_WITH_TIME, "$1")).otherwise(trimmed)
    return F.coalesce(*[F.try_to_date(_with_marks(day, fmt), fmt) for fmt in formats])


def _with_marks(day: Column, fmt: str) -> Column:
    """The text where it has every mark of a format of letters and plain marks."""
    if not re.fullmatch(r"[A-Za-z/., -]+", fmt):
        return day
    marks = sorted(set(re.findall(r"[^A-Za-z]", fmt)))
    if not marks:
        return day
    return F.when(reduce(Column.__and__, [F.contains(day, F.lit(m)) for m in marks]), day)


def date_key(day: Column) -> Column:
    """The day as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_parts(day: Column) -> list[Column]:
    """Every column of the date dimension, derived from one day."""
    return [
        date_key(day).alias("DateKey"),
        day.alias("FullDate"),
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("Day"),
        F.quarter(day).alias("Quarter"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.date_format(day, "EEEE").alias("DayOfWeek"),
    ]


def iso_text(day: Column) -> Column:
    """The day as yyyy-mm-dd; the cast is cheaper than a format."""
    return day.cast("string")
