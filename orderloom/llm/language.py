"""Language identification by bit-sliced Bloom filters of byte n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.bytehash import mixed
from orderloom.llm.common import BROADCAST_KEYS, ship, staged
from orderloom.llm.tokens import chunks, forget

UNKNOWN = "und"
NGRAM = 5  # bytes
SLOTS = 2**21
HASHES = 3
#: At most so many documents of each language are learned from where a sample is asked for.
SAMPLE_PER_LANGUAGE = 2000
#: Of the held-out documents that are named rightly, this share may lie below the least score.
LOST = 0.0005
#: Bins that a range of scores is cut into to find the one of a rank.
BINS = 4096
#: An n-gram belongs to a language if it is in two of its documents and in this share of them at
#: least, and the share reaches this part of the largest share in any language.
LEAST_SHARE = 0.001
PURITY = 0.1
#: N-grams, once a document, that are counted at once in a task.
GRAMS_AT_ONCE = 2_000_000

_BLANKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letters(text: str | None) -> bool:
    if not text:
        return False
    return any(map(str.isalpha, text[:256])) or any(map(str.isalpha, text[256:]))


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mixed n-gram values of all texts one after another, and the texts' bounds in them.

    Texts are lower-cased and every ASCII character but letters reads as a blank. A text
    begins and ends with a blank; n-grams that cross from one text to the next do not count.
    """
    data = [b"  " + text.lower().encode("utf-8", "replace").translate(_BLANKS) + b"  " for text in texts]
    bounds = np.cumsum([0, *map(len, data)])
    joined = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint64)
    count = len(joined) - NGRAM + 1
    values = np.zeros(max(count, 0), dtype=np.uint64)
    for i in range(NGRAM):
        values |= joined[i : i + count] << np.uint64(8 * i)
    return mixed(values), bounds


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    """The filter positions of each n-gram, one array per hash."""
    width = np.uint64(SLOTS.bit_length() - 1)
    return [((grams >> (width * np.uint64(i))) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass(frozen=True)
class Model:
    """`table` has one row of bits per filter position, a bit per language: one look-up
    answers for all languages. `wrong` is each language's rate of false positives."""

    languages: list[str]
    table: np.ndarray
    wrong: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """For texts with letters: the language and the corrected share of n-grams it holds."""
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        grams, bounds = _grams(texts)
        first, *others = _slots(grams)
        bits = self.table[first]
        for slots in others:
            bits &= self.table[slots]
        starts, ends = bounds[:-1], bounds[1:] - NGRAM + 1
        hits = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            sums = np.concatenate([[0], np.cumsum((bits[:, i // 8] >> np.uint8(i % 8)) & np.uint8(1), dtype=np.int64)])
            hits[:, i] = sums[ends] - sums[starts]
        total = (ends - starts)[:, None]
        right = np.clip((hits - total * self.wrong) / (1 - np.minimum(self.wrong, 0.999)), 0, None)
        best = right.argmax(axis=1)
        score = np.clip(right[np.arange(len(texts)), best] / total[:, 0], 0, 1)
        return [self.languages[i] for i in best], score.tolist()


def held_out(key: Column) -> Column:
    """True for keys whose decimal text has a CRC-32 of 2 modulo 4; null keys are not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _distinct(spark: SparkSession, complete: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """All distinct rows (lang, text), by lang and hash, and their number in each language.

    Only the hashes are grouped; of the rows, those whose hash comes more than once are
    shuffled.
    """
    keys = staged(spark, complete.groupBy("lang", "hash").count())
    sizes = {row["lang"]: row["count"] for row in keys.groupBy("lang").count().collect()}
    twice = keys.where("count > 1").select("lang", "hash")
    repeated = twice.count()
    if not repeated:
        return complete.select("lang", "text"), sizes
    twice = F.broadcast(twice) if repeated <= BROADCAST_KEYS else twice
    once = complete.join(twice, ["lang", "hash"], "left_anti")
    first = complete.join(twice, ["lang", "hash"], "left_semi").dropDuplicates(["lang", "hash"])
    return once.unionByName(first).select("lang", "text"), sizes


def _sampled(spark: SparkSession, complete: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The sampled rows (lang, text), and their number in each language."""
    rows = {row["lang"]: row["count"] for row in complete.groupBy("lang").count().collect()}
    if not rows:
        return complete.select("lang", "text"), {}
    share = F.create_map(*(F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, 2 * SAMPLE_PER_LANGUAGE / n))))
    below = F.pmod("hash", F.lit(2**30)) < share[F.col("lang")] * 2**30
    some = complete.where(below).dropDuplicates(["lang", "hash"])
    order = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(2**30)), "hash")
    ranked = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_PER_LANGUAGE)
    sample = staged(spark, ranked.select("lang", "text"))
    sizes = {row["lang"]: row["count"] for row in sample.groupBy("lang").count().collect()}
    return sample.repartition(spark.sparkContext.defaultParallelism * 2), sizes


def learn(spark: SparkSession, labelled: DataFrame, whole: bool = False) -> Model:
    """A model from rows (doc_id, text, lang); rows with a null in any of the three do not count.

    If `whole`, every distinct document counts. Otherwise those SAMPLE_PER_LANGUAGE of each language
    do that have the smallest hash of doc_id and text; rows are first held against a threshold
    that the number of the language's rows gives, so that a language or a document that many
    rows share brings a bounded number of rows together. Only bounded data reach the driver: rows
    per language and the filters' bits, 64 positions to a row.
    """
    ship(spark)
    hashed = F.xxhash64("doc_id", "text").alias("hash")
    complete = labelled.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), hashed
    )
    if whole:
        sample, sizes = _distinct(spark, complete)
    else:
        sample, sizes = _sampled(spark, complete)
    if not sizes:
        return Model([], np.zeros((SLOTS, 1), dtype=np.uint8), np.zeros(0))
    languages = sorted(sizes)

    def counts_of(lang: str, seen: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(seen), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.array([lang] * len(values)), pa.array(counts.astype(np.int64))],
            ["gram", "lang", "docs"],
        )

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                seen, held = [], 0
                for some in chunks(batch.column(1).filter(pc.equal(batch.column(0), lang))):
                    grams, bounds = _grams(some)
                    seen += [np.unique(grams[a : b - NGRAM + 1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    held += len(grams)
                    if held >= GRAMS_AT_ONCE:
                        yield counts_of(lang, seen)
                        seen, held = [], 0
                if seen:
                    yield counts_of(lang, seen)

    size_of = F.create_map(*(F.lit(x) for lang in languages for x in (lang, float(sizes[lang]))))
    counted = sample.mapInArrow(grams_of, "gram long, lang string, docs long")
    shares = (
        counted.groupBy("gram", "lang")
        .agg(F.sum("docs").alias("docs"))
        .withColumn("share", F.col("docs") / size_of[F.col("lang")])
        .where(F.col("share") >= LEAST_SHARE)
    )
    largest = F.max("share").over(Window.partitionBy("gram"))
    enough = (F.col("docs") >= 2) | (size_of[F.col("lang")] < 20)
    kept = shares.withColumn("largest", largest).where(enough & (F.col("share") >= PURITY * F.col("largest")))
    width = SLOTS.bit_length() - 1
    slots = F.explode(F.array(*(F.shiftrightunsigned("gram", width * i).bitwiseAND(SLOTS - 1) for i in range(HASHES))))
    words = (
        kept.select("lang", slots.alias("slot"))
        .groupBy("lang", F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros((SLOTS, -(-len(languages) // 8)), dtype=np.uint8)
    lang_of = np.array([languages.index(x) for x in words.column("lang").to_pylist()], dtype=np.int64)
    word = words.column("word").to_numpy()
    bits = words.column("bits").to_numpy().view(np.uint64)
    for i in range(len(languages)):
        own = lang_of == i
        packed = np.zeros(SLOTS // 64, dtype="<u8")
        packed[word[own]] = bits[own]
        flags = np.unpackbits(packed.view(np.uint8), bitorder="little")
        table[:, i // 8] |= flags << np.uint8(i % 8)
    filled = [((table[:, i // 8] >> np.uint8(i % 8)) & 1).mean() for i in range(len(languages))]
    return Model(languages, table, np.array(filled) ** HASHES)


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The documents as `row`, with `lang_pred` and `score`, in one pass without a shuffle.

    A null text or one without letters is `und` with score 0; so is every text if nothing
    was learned. A text whose n-grams no language holds gets the first language and score 0.
    Whole texts count. Repeated rows are predicted alike; an empty table gives no rows.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            langs, scores = [], []
            for texts in chunks(batch.column(1)):
                able = [i for i, text in enumerate(texts) if has_letters(text)]
                found = dict(zip(able, zip(*shared.value.predict([texts[i] for i in able]), strict=True), strict=True))
                for i in range(len(texts)):
                    lang, score = found.get(i, (UNKNOWN, 0.0))
                    langs.append(lang)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"]
            )

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(predict, schema)


def language_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), learned from what is not held out."""
    model = learn(spark, docs.where(~held_out(F.col("doc_id"))), whole=True)
    return identify(spark, docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def with_letters(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents whose text has letters, their columns as they came."""
    ship(spark)

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            able = [has_letters(text) for texts in chunks(batch.column(1)) for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(able, pa.bool_()))], ["row"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(letters, f"row {rows.schema['row'].dataType.simpleString()}").select("row.*")


def least_score(spark: SparkSession, docs: DataFrame, model: Model) -> float:
    """The score that all but the share LOST of rightly named held-out documents reach.

    Every held-out row with text and lang is scored, and distinct texts of a language count once.
    0 where there are none.
    """
    labelled = docs.where(held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("hash"))
    right = identify(spark, rows, model).where(F.col("row.lang") == F.col("lang_pred"))
    scores = staged(spark, right.select("row.lang", "row.hash", "score").distinct())
    count = scores.count()
    return ranked_value(scores, "score", math.ceil(LOST * count)) if count else 0.0


def ranked_value(rows: DataFrame, column: str, rank: int) -> float:
    """The value of a rank, from 1, in ascending order; the rows should be staged and not null.

    The range that holds it is cut into BINS until one value is left, so at most a row per bin
    reaches the driver.
    """
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        place = F.least(F.lit(BINS - 1), F.floor((value - F.lit(low)) / F.lit(high - low) * BINS))
        inside = rows.where(value.between(low, high)).groupBy(place.alias("bin"))
        bins = inside.agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
        for found in bins.orderBy("low").collect():
            if rank <= found["rows"]:
                low, high = found["low"], found["high"]
                break
            rank -= found["rows"]
    return low


def drop_unknown(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents of a learned language, their columns as they came.

    The model is learned from all rows that carry a `lang` and are not held out; all held-out rows
    give the `least_score`. Rejected are texts without letters and those whose score is below it:
    too few of their n-grams are known in any language. Where no row can be learned from,
    letters alone decide.
    """
    model = learn(spark, docs.where(~held_out(F.col("doc_id"))), whole=True)
    if not model.languages:
        return with_letters(spark, docs)
    least = least_score(spark, docs, model)
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return identify(spark, docs, model).where(kept).select("row.*")
