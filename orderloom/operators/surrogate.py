"""Dense surrogate keys in source order, numbered without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schemas import POSITION


def dense_keys(values: DataFrame, key: str) -> DataFrame:
    """Number the rows 1..n by position.

    A row's number is its rank inside its source part plus the rows of all parts
    before. Parts are ranked apart from each other; only one count per part (a file
    split or key range that holds a first appearance) meets in a single task.
    """
    in_part = Window.partitionBy("_part").orderBy(POSITION)
    earlier_parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn("_part", F.col(f"{POSITION}.part")).withColumn(
        "_rank", F.row_number().over(in_part)
    )
    offsets = (
        ranked.groupBy("_part")
        .agg(F.max("_rank").alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_rows").over(earlier_parts), F.lit(0)).alias("_offset"),
        )
    )
    return (
        ranked.join(offsets, "_part")
        .withColumn(key, F.col("_offset") + F.col("_rank"))
        .drop("_part", "_rank", "_offset")
    )
