"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import staged, text_or_empty

SAMPLES = 32
ROWS_PER_BUCKET = 4096
#: Buckets of the document order at most; beyond so many their rows grow, and the sorted
#: buckets spill. The driver and the plan hold one number for each (0.5 MB).
MOST_BUCKETS = 65_536
_PART = 2**25  # a uniform number has 25 bits, or 28 where it is put together of two rests
_ID_BITS = 23


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def weighted_terms(text: Column) -> Column:
    """Array of (term, weight): 64-bit hashes of the distinct words and how often they occur."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def starts(sorted_: Column) -> Column:
        new = lambda i: (i == 0) | (F.get(sorted_, i) != F.get(sorted_, i - 1))
        return F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), new)

    def runs(sorted_: Column) -> Column:
        return _let(
            starts(sorted_),
            lambda first: F.transform(
                first,
                lambda at, i: F.struct(
                    F.get(sorted_, at).alias("term"),
                    (F.coalesce(F.get(first, i + 1), F.size(sorted_)) - at).alias("weight"),
                ),
            ),
        )

    none = F.array().cast("array<struct<term:bigint,weight:int>>")
    return _let(hashes, lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


def _draw(term: Column, log_weight: Column, sample: int) -> Column:
    """One term's draw for one sample as a long: the smallest in a document is its sample.

    With r and c from Gamma(2, 1) and b uniform, all fixed by term and sample, the draw is
    t = floor(ln w / r + b) at the level ln a = ln c - r (t - b + 1). The level fills the high
    bits, the low ones name term and t.
    """
    one, two = F.xxhash64(term, F.lit(2 * sample)), F.xxhash64(term, F.lit(2 * sample + 1))

    def uniform(x: Column, shift: int) -> Column:
        return (F.shiftrightunsigned(x, shift).bitwiseAND(_PART - 1) + F.lit(0.5)) / F.lit(float(_PART))

    r = -F.log(uniform(one, 0) * uniform(one, 25))
    c = -F.log(uniform(two, 0) * uniform(two, 25))
    rest = F.shiftleft(F.shiftrightunsigned(one, 50), 14) + F.shiftrightunsigned(two, 50)
    b = rest / F.lit(float(2**28))
    t = F.floor(log_weight / r + b)
    level = F.log(c) - r * (t - b + F.lit(1.0))
    order = ((level + F.lit(128.0)) * F.lit(float(2**32))).cast("long")
    return F.shiftleft(order, _ID_BITS) + two.bitwiseXOR(t).bitwiseAND(2**_ID_BITS - 1)


def signatures(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """The keys with `signature`, an array of sample ids, empty for a text without words.

    A position of two signatures agrees with the chance min-sum / max-sum of the word counts.
    Words are split and counted inside their row; the minima need no shuffle if rows are
    already partitioned by some of the keys, and shuffle one row per text otherwise.
    """
    term = F.explode_outer(weighted_terms(F.col(text))).alias("t")
    terms = rows.select(*keys, term).select(
        *keys, F.col("t.term").alias("term"), F.log(F.col("t.weight").cast("double")).alias("log_weight")
    )
    least = [F.min(_draw(F.col("term"), F.col("log_weight"), k)).alias(f"s{k}") for k in range(samples)]
    ids = F.array(*(F.col(f"s{k}").bitwiseAND(2**_ID_BITS - 1) for k in range(samples)))
    none = F.array().cast("array<bigint>")
    return terms.groupBy(*keys).agg(*least).select(
        *keys, F.when(F.col("s0").isNotNull(), ids).otherwise(none).alias("signature")
    )


def likeness(one: Column, other: Column) -> Column:
    """Share of positions that agree; two texts without words are alike, one is like no other."""
    same = F.size(F.filter(F.zip_with(one, other, lambda x, y: x == y), lambda s: s))
    both_empty = (F.size(one) == 0) & (F.size(other) == 0)
    either = (F.size(one) == 0) | (F.size(other) == 0)
    return F.when(both_empty, F.lit(1.0)).when(either, F.lit(0.0)).otherwise(same / F.size(one)).cast("double")


def hexadecimal(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def _numbers(values: list) -> Column:
    """One literal, however many numbers it holds."""
    return F.lit(np.array(values, dtype=np.int64))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    table = _numbers(bounds)
    reached = F.size(F.filter(_numbers(bounds[::width]), lambda x: x <= key))
    block = F.slice(table, (reached - 1) * width + 1, F.lit(width))
    inside = F.size(F.filter(block, lambda x: x <= key))
    return F.when(reached == 0, F.lit(0)).otherwise((reached - 1) * width + inside)


def _heads(rows: DataFrame, rows_per_bucket: int) -> tuple[list[int], list[int]]:
    """The smallest doc_id of each bucket, ascending, and how many buckets' worth of rows it has alone."""
    stats = rows.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("least")).first()
    if not stats["n"]:
        return [], []
    buckets = max(1, min(MOST_BUCKETS, stats["n"] // rows_per_bucket))
    fractions = [i / buckets for i in range(1, buckets)]
    keys = F.percentile_approx("doc_id", fractions, max(10_000, 10 * buckets))
    found = Counter(rows.agg(keys).first()[0] if fractions else [])
    heads = sorted({stats["least"], *found})
    return heads, [max(1, found[x]) for x in heads]


def _in_order(docs: DataFrame, rows_per_bucket: int) -> tuple[DataFrame, DataFrame | None]:
    """What with_next returns, and rows (doc_id, text, times) of copies that are their own next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    heads, pieces = _heads(rows, rows_per_bucket)
    keyed = rows.where("doc_id IS NOT NULL").withColumns({"last": F.lit(False), "standing": F.lit(False)})
    own = _bucket(F.col("doc_id"), heads[1:])
    is_head = F.col("doc_id") == F.get(_numbers(heads), own) if heads else F.lit(False)
    crowd = None
    if max(pieces, default=1) > 1:
        bases = np.cumsum([len(heads), *pieces[:-1]]).tolist()
        sorted_out = keyed.withColumn("pieces", F.when(is_head, F.get(_numbers(pieces), own)).otherwise(1))
        crowd = _crowd(
            sorted_out.where("pieces > 1").withColumn("base", F.get(_numbers(bases), own)).select("doc_id", "text", "pieces", "base")
        )
        keyed = sorted_out.where("pieces = 1").drop("pieces").unionByName(_stand_ins(*crowd))
    before = F.when(own == 0, F.lit(len(heads) - 1)).otherwise(own - 1)
    host = F.struct(own.alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("bucket"), F.lit(True).alias("guest"))
    places = F.explode(F.when(is_head, F.array(host, guest)).otherwise(F.array(host))).alias("at")
    dealt = keyed.select("doc_id", "text", "last", "standing", places).select("at.*", "doc_id", "text", "last", "standing")
    order = Window.partitionBy("bucket").orderBy("guest", "doc_id", "last", F.xxhash64("text"))
    columns = ["bucket", F.row_number().over(order).alias("place")]
    following = F.lead("text").over(order).alias("next_text")
    plain = dealt.select(*columns, (F.col("guest") | F.col("standing")).alias("guest"), "doc_id", "text", following)
    if crowd is None:
        return plain, None
    copies = crowd[0].where("copies > 1").select("doc_id", "text", (F.col("copies") - 1).alias("times"))
    return plain.unionByName(_inside(*crowd)), copies


def _crowd(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text, pieces, base) of ids that fill several buckets, dealt over these by the text's hash.

    Equal rows of one input split become one with `copies`, so a row that a third of the
    table repeats stays one per split. Also the parts: bounds of the hash in each bucket that
    has rows, and the bucket before it. There are at most twice MOST_BUCKETS of them.
    """
    spark = rows.sparkSession
    split = rows.withColumn("split", F.spark_partition_id())
    one = split.groupBy("doc_id", "text", "pieces", "base", "split").agg(F.count(F.lit(1)).alias("copies"))
    share = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * F.col("pieces"))
    piece = F.col("base") + F.least(share, F.col("pieces") - 1)
    one = staged(spark, one.withColumn("hash", F.xxhash64("text")).withColumn("bucket", piece.cast("int")).drop("base", "pieces"))
    order = Window.partitionBy("doc_id").orderBy("bucket")
    parts = one.groupBy("doc_id", "bucket").agg(F.min("hash").alias("least"), F.max("hash").alias("most"))
    return one, staged(
        spark, parts.withColumns({"before": F.lag("bucket").over(order), "after": F.lead("bucket").over(order)})
    )


def _stand_ins(one: DataFrame, parts: DataFrame) -> DataFrame:
    """The first and the last text of each crowded id, which stand for all its rows between other ids.

    The last one's next document is found there; the first is there as the next one only.
    """
    ends = one.join(F.broadcast(parts), ["doc_id", "bucket"])
    first = ends.where("before IS NULL AND hash = least").groupBy("doc_id").agg(F.min("text").alias("text"))
    last = ends.where("after IS NULL AND hash = most").groupBy("doc_id").agg(F.max("text").alias("text"))
    return first.withColumns({"last": F.lit(False), "standing": F.lit(True)}).unionByName(
        last.withColumns({"last": F.lit(True), "standing": F.lit(False)})
    )


def _inside(one: DataFrame, parts: DataFrame) -> DataFrame:
    """Each row of a crowded id beside the next one of that id; the last is marked as a guest."""
    heads = one.join(F.broadcast(parts), ["doc_id", "bucket"]).where("before IS NOT NULL AND hash = least")
    guests = heads.groupBy("doc_id", "before", "hash").agg(F.min("text").alias("text"))
    dealt = one.select("bucket", F.lit(False).alias("guest"), "doc_id", "hash", "text", "split").unionByName(
        guests.select(
            F.col("before").alias("bucket"), F.lit(True).alias("guest"), "doc_id", "hash", "text", F.lit(-1).alias("split")
        )
    )
    order = Window.partitionBy("bucket").orderBy("guest", "hash", "text", "split")
    return dealt.withColumns({"place": F.row_number().over(order), "next_text": F.lead("text").over(order)}).select(
        "bucket", "place", (F.col("guest") | F.col("next_text").isNull()).alias("guest"), "doc_id", "text", "next_text"
    )


def with_next(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows (bucket, place, guest, doc_id, text, next_text): each document beside the next one.

    Documents in ascending doc_id order are dealt over buckets of about as many rows, and the
    first document of each bucket is a guest at the end of the bucket before; after the last
    document comes the first. So one shuffle brings all neighbours together, without a global
    sort. Equal doc_ids follow by the text's hash; an id that fills several buckets is dealt
    over them by that hash, and of its equal rows only one per input split is returned, as
    the others are their own next documents. So is a row without doc_id.
    """
    return _in_order(docs, rows_per_bucket)[0]


def edited_text(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprint_documents(
    spark: SparkSession, docs: DataFrame, samples: int = SAMPLES, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    One row per document. A null text is an empty one; a text without words has an empty
    fingerprint. Equal texts have equal fingerprints. A row without doc_id stands outside the
    order and is its own next document; repeated rows follow each other. Other columns are
    ignored; an empty table gives no rows.
    """
    pairs, copies = _in_order(docs, rows_per_bucket)
    both = pairs.withColumn("edited", edited_text(F.col("text"), F.coalesce("next_text", F.lit(""))))
    info = ["bucket", "place", "guest", "doc_id", "n_chars", "edited_sha256", "kind"]
    sides = both.select(
        "bucket",
        "place",
        "guest",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("kind", "side"),
    )
    signed = signatures(sides, info, "side", samples)
    # In order of place and kind, a text is followed by its edited text and then by the next text.
    order = Window.partitionBy("bucket").orderBy("place", "kind")
    compared = signed.withColumns(
        {"edited": F.lead("signature", 1).over(order), "following": F.lead("signature", 2).over(order)}
    ).where("kind = 0 AND NOT guest")
    ordered = _compared(compared)
    alone = docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), text_or_empty().alias("text"))
    result = ordered.unionByName(_compared(_next_to_themselves(alone, samples)))
    if copies is None:
        return result
    # Each task multiplies the copies of some splits only; a fixed number of tasks is not merged.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    again = _next_to_themselves(copies, samples).repartition(tasks, "place")
    times = F.explode(F.sequence(F.lit(1), "times")).alias("time")
    return result.unionByName(_compared(again.select("*", times)))


def _next_to_themselves(rows: DataFrame, samples: int) -> DataFrame:
    """Signatures of rows (doc_id, text, ...) whose next document is the same text."""
    others = [name for name in rows.columns if name != "text"]
    sides = rows.withColumn("place", F.monotonically_increasing_id()).select(
        *others,
        "place",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(edited_text(F.col("text"), F.col("text")).cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array(F.col("text"), edited_text(F.col("text"), F.col("text")))).alias("kind", "side"),
    )
    order = Window.partitionBy("place").orderBy("kind")
    signed = signatures(sides, [*others, "place", "n_chars", "edited_sha256", "kind"], "side", samples)
    return signed.withColumns({"edited": F.lead("signature").over(order), "following": F.col("signature")}).where("kind = 0")


def _compared(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("signature")).alias("fingerprint"),
        hexadecimal(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited")).alias("near_edited"),
        likeness(F.col("signature"), F.col("following")).alias("near_next"),
    )
