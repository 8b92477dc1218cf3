"""Sharding by jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import numbered, staged

# A key jumps about ln(shards) times. Any key that is not done after this many
# draws goes on through the remaining draws, of which there are at most `shards`.
_USUAL_JUMPS = 48


def _jumped(key: Column, shards: int, state: Column, first: int, stop: int) -> Column:
    """The state after draws first..stop-1: the last bucket below `shards`, and the next jump."""

    def jump(state: Column, draw: Column) -> Column:
        random = F.shiftrightunsigned(F.xxhash64(key, draw), 33) + F.lit(1)
        target = ((state["next"] + 1).cast("double") * F.lit(float(2**31)) / random.cast("double")).cast("long")
        moved = F.struct(state["next"].alias("bucket"), target.alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(first), F.lit(stop - 1)), state, jump)


def jump_state(key: Column, shards: int) -> Column:
    """Struct of `bucket`, the shard of the key, and `next`, where the key jumps from there.

    With more shards, up to and including `next`, the key stays where it is; with
    next + 1 shards it moves to shard `next`, the new one.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    start = F.struct(F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("next"))
    usual = min(shards, _USUAL_JUMPS)
    state = _jumped(key, shards, start, 0, usual)
    if shards == usual:
        return state
    return F.when(state["next"] >= shards, state).otherwise(_jumped(key, shards, state, usual, shards))


def shard_documents(
    spark: SparkSession, docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot, grown_shard), one per input row.

    The shard depends on the key and the number of shards alone; with one more shard
    a row stays or moves into the new one (`grown_shard`). A null key is a key like any
    other: all such rows share a shard. Size is the text's UTF-8 bytes plus 1; a null
    text has no bytes and the CRC of an empty text. Repeated rows each get a slot of
    their own. An empty table gives no rows; other columns are ignored.

    Slots are gapless from 0 in each shard without a sort of the shard: rows are
    numbered inside each input split, whose counts give the offsets. So a shard or key
    that holds most rows is numbered in as many pieces as there are splits.
    """
    state = jump_state(F.col(key), shards)
    grown = F.when(state["next"] == shards, F.lit(shards).cast("long")).otherwise(state["bucket"])
    data = F.col(text).cast("binary")
    digest = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(data), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
        state["bucket"].cast("int").alias("shard"),
        grown.cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Written first: the numbering must see the same splits wherever it reads them.
    return numbered(staged(spark, digest), "shard", "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"
    )
