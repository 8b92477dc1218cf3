"""Predicates of the quality rules; each is true for a violating row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import strip


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def not_positive(number: Column) -> Column:
    return number.isNull() | (number <= 0)


def negative_or_null(number: Column) -> Column:
    return number.isNull() | (number < 0)


def not_listed_or_null(value: Column, allowed: Sequence[str]) -> Column:
    """Outside the list, and a null is outside too."""
    return F.coalesce(~value.isin(*allowed), F.lit(True))


def not_listed(value: Column, allowed: Sequence[str]) -> Column:
    """Outside the list, but a null passes."""
    return F.coalesce(~value.isin(*allowed), F.lit(False))
