"""Number expressions. Casts return null on bad text: ANSI casts would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import AMOUNT
from orderloom.functions.text import strip


# A failed cast costs an exception, so texts with a printable character that no such number has are
# not cast at all.
NOT_WHOLE = r"[!-*,./:-~]"
NOT_DECIMAL = r"[!-*,/:-DF-df-~]"


def _without(text: Column, misfits: str) -> Column:
    return F.when(~text.rlike(misfits), text)


def to_whole(text: Column) -> Column:
    """Text to bigint. `5.0` is 5, as a column with gaps is often written so."""
    trimmed = strip(text)
    exact = _without(trimmed, NOT_DECIMAL).try_cast("decimal(38,6)")
    return F.coalesce(
        _without(trimmed, NOT_WHOLE).try_cast("bigint"),
        F.when(exact == F.floor(exact), exact.try_cast("bigint")),
    )


def to_typed(text: Column, dtype: T.DataType) -> Column:
    """Text to a source column's type; null where the text does not fit."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.LongType):
        return to_whole(text)
    if isinstance(dtype, T.DecimalType):
        return _without(strip(text), NOT_DECIMAL).try_cast(dtype)
    return strip(text).try_cast(dtype)


def line_amount(matched: Column, price: Column, quantity: Column) -> Column:
    """Price times quantity: 0 for an unknown product, null for a missing price or an overflow."""
    unit = F.when(matched, price).otherwise(F.lit(0))
    return F.try_multiply(unit, quantity).try_cast(AMOUNT)


def rounded(total: Column, digits: int = 2) -> Column:
    """Round a decimal half away from zero, then hand it out as a double."""
    return F.round(total, digits).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal, divided exactly as decimals."""
    return rounded((part * 100).cast("decimal(24,4)") / whole.cast("decimal(20,0)"), 1)
