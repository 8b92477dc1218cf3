"""Mixing sources to target weights by repetition rates and hash-seeded draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import staged, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Sources in code point order, null last, take the weights in turn and share all
    sizes by weight; no target exceeds `most` times its source's size, and what is cut
    off is shared anew by weight until none is above. That has a closed form: in order
    of size per weight, sources are cut off as long as the level that the rest would
    get, per weight, is above theirs. One row per source meets in the two global windows.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (rank % len(weights) + 1).cast("int")).cast("long")
    weighed = by_source.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    order = Window.orderBy(
        (F.col("most") / F.col("weight")), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(order), F.lit(0))
    shares = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0))
    leveled = weighed.withColumn("level", left.cast("double") / shares.cast("double"))
    # The level rises as long as sources are cut off and falls after that; the highest one holds.
    level = F.max("level").over(everything)
    share = level * F.col("weight")
    target = F.when(share >= F.col("most"), F.col("most").cast("double")).otherwise(share)
    return leveled.select("source", "source_size", target.alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key's text, which is not null, and the seed alone."""
    name = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def with_copies(
    spark: SparkSession, docs: DataFrame, seed: int = 9, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """Rows (row, size, source_size, target, copies): `row` is the document as a struct.

    `copies` is the whole part of target / source_size, plus one if the document's draw
    is below the fraction. The draw depends on doc_id and seed, so reruns agree. A row without
    doc_id draws by its text's hash and its place in the table, so that such rows too come near
    their target; rows that repeat a doc_id draw alike. A null text has size 0, and a source of
    size 0 is taken 0 times. Documents of one source are never brought together: sizes are summed
    in each map task and a source's target comes back by a join.
    """
    nameless = F.concat(F.lit("text:"), F.xxhash64("text"), F.lit(":"), F.monotonically_increasing_id())
    rows = docs.select(
        F.struct("*").alias("row"),
        word_count(F.col("text")).alias("size"),
        F.col("source"),
        F.coalesce(F.col("doc_id").cast("string"), nameless).alias("key"),
    )
    sizes = staged(spark, docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("size")))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("of")))
    drawn = uniform(F.col("key"), seed) < rate - F.floor(rate)
    copies = (F.floor(rate) + drawn.cast("int")).cast("int")
    return joined.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix_sources(spark: SparkSession, docs: DataFrame, seed: int = 9) -> DataFrame:
    """The documents, each as many times as the mix takes it; columns as they came."""
    taken = with_copies(spark, docs, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def mix_digest(spark: SparkSession, docs: DataFrame, seed: int = 9) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one per document."""
    narrow = docs.select("doc_id", "source", "text")
    return with_copies(spark, narrow, seed).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )
