"""Left lookups from a large table into one that is unique by key.

A caller that has counted the table's rows may ask for a broadcast below a bound.
Otherwise Spark compares the estimated size with its own threshold, and beyond it
sorts and merges, splitting hot keys where they are skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHED = "_matched"

# Rows of a key and a number that are broadcast: about 200 MB as a hash table.
BROADCAST_ROWS = 4_000_000


def left_lookup(
    rows: DataFrame,
    key: Column,
    table: DataFrame,
    table_key: str,
    counted_rows: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the table's columns and `_matched`: true on a hit, null like them on a miss.

    `counted_rows` is the table's size if known; one up to `broadcast_rows` spares the
    large side a shuffle, unless the session forbids broadcasts. Pass it for tables of a
    few fixed-width columns only.
    """
    side = table.select(
        F.col(table_key).alias("_lookup"),
        *[name for name in table.columns if name != table_key],
        F.lit(True).alias(MATCHED),
    )
    allowed = not rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    if allowed and counted_rows is not None and counted_rows <= broadcast_rows:
        side = F.broadcast(side)
    return rows.join(side, key == F.col("_lookup"), "left").drop("_lookup")
