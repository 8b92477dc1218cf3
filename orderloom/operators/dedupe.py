"""De-duplication that keeps the row standing first in the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schemas import POSITION


def keep_first(rows: DataFrame, key: str) -> DataFrame:
    """The first row of each key by source position.

    The rank filter runs on both sides of the shuffle, so each map task sends one
    row per key at most and a heavily copied key stays small.
    """
    by_position = Window.partitionBy(key).orderBy(POSITION)
    return (
        rows.withColumn("_rank", F.row_number().over(by_position))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    """The non-null values of a column, once each."""
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def first_appearance(rows: DataFrame, column: str) -> DataFrame:
    """Each non-null value once, with the position where it first appears.

    The smallest row in each part comes first, then the smallest part: two plain minima that are
    hashed, where one minimum of a pair would sort all rows.
    """
    named = rows.where(F.col(column).isNotNull())
    part, row = F.col(f"{POSITION}.part"), F.col(f"{POSITION}.row")
    in_part = named.groupBy(column, part.alias("_part")).agg(F.min(row).alias("_row"))
    firsts = in_part.groupBy(column).agg(
        F.min("_part").alias("_part"), F.min_by("_row", "_part").alias("_row")
    )
    position = F.struct(F.col("_part").alias("part"), F.col("_row").alias("row"))
    return firsts.select(column, position.alias(POSITION))
