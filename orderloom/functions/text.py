"""Text expressions: trimming, null tokens, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space, the ASCII ones first.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
    "\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that stand for a missing value in a CSV file.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip(text: Column) -> Column:
    """Trim all white space at both ends; Spark's bare trim() takes spaces only.

    Trimming searches the whole list, so texts that begin and end with printable ASCII are left
    as they are at once.
    """
    ends = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(ends, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def null_if_token(text: Column) -> Column:
    """Null where the untrimmed cell is one of the null tokens."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one blank between; null if either is null."""
    return F.concat(strip(first), F.lit(" "), strip(last))


def shown(value: Column) -> Column:
    """Text of a value inside a message, where a missing value reads 'nan'."""
    return F.coalesce(value.cast("string"), F.lit("nan"))


def shown_decimal(value: Column) -> Column:
    """Like shown(), without the zeros that the decimal scale pads on."""
    return F.coalesce(
        F.regexp_replace(value.cast("string"), r"\.?0+$", ""), F.lit("nan")
    )
