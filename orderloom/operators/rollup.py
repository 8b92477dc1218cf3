"""Additive measures, summed by key before any join and again after it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measure_by(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate raw rows; only the keys and the measured columns are read."""
    return rows.groupBy(*keys).agg(*[agg.alias(name) for name, agg in measures.items()])


def sums_by_each(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregates by each key apart, in one pass: rows (keys, measures, grain).

    `grain` names the key a row is summed by; the other keys are null there. Map tasks sum before
    the shuffle, so a row of the input costs nothing there but its distinct keys.
    """
    columns = [F.col(key) for key in keys]
    # A set's number has a bit for each key that is not in it, the first key's highest.
    every = 2 ** len(keys) - 1
    grain = F.coalesce(
        *[
            F.when(F.grouping_id(*columns) == every - 2 ** (len(keys) - 1 - i), F.lit(key))
            for i, key in enumerate(keys)
        ]
    )
    sets = [[column] for column in columns]
    return rows.groupingSets(sets, *columns).agg(
        *[agg.alias(name) for name, agg in measures.items()], grain.alias("grain")
    )


def roll_up(
    partial: DataFrame,
    dimension: DataFrame,
    on: str,
    by: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Carry partial sums from a dimension's key up to other columns.

    `partial` holds one row per key, or few, so a key that owns a third of all
    facts weighs no more in the join than any other.
    """
    wanted = [on, *[name for name in by if name in dimension.columns and name != on]]
    joined = partial.join(dimension.select(*wanted), on)
    return joined.groupBy(*by).agg(*[F.sum(name).alias(name) for name in measures])
