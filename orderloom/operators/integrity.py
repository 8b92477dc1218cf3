"""Referential and key checks that shuffle counts per key, never the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of the child the parent lacks, with their row counts; nulls are no orphans."""
    wanted = key_counts(child.where(F.col(key).isNotNull()), key)
    known = parent.select(F.col(parent_key).alias(key))
    return wanted.join(known, key, "left_anti")


def orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: how many child rows point at no parent."""
    orphans = orphan_keys(child, key, parent, parent_key)
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return key_counts(rows, key).where(F.col("_rows") > 1)


def duplicate_key_count(rows: DataFrame, key: str) -> DataFrame:
    """One row: how many keys occur more than once."""
    return duplicate_keys(rows, key).agg(F.count(F.lit(1)).alias("violations"))
