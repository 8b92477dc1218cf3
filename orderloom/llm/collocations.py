"""Collocations by multikey three-way quicksort of suffix pointers.

A suffix is the run of words from one place of a piece to its end, at most five. Two passes:
the first counts words and pairs of words, summed inside each task's run of text before they
are shuffled. In the second, a suffix goes no further than pairs that are frequent everywhere;
suffixes are routed by language and their first three words, and each task sorts pointers to
its suffixes, word by word, in three ways. The weight of an equal partition is the count of a
phrase, and a partition below the threshold is abandoned with all that is in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.bytehash import SliceHashes, mixed
from orderloom.llm.common import BROADCAST_KEYS, ship, staged, whole_groups

LONGEST = 5
LEAST = 100
TOP = 2000
#: Words of the run of text that a task sums up at once.
RUN_WORDS = 600_000
#: Positions of the filter of frequent pairs: 16 per pair, at most so many (32 MB). Beyond that
#: it lets more suffixes through, which costs shuffles and loses nothing.
MOST_POSITIONS = 2**28
NO_LANGUAGE = "und"

# What ends a piece and what parts words.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_CLEANED = bytes.maketrans(
    _PIECE_ENDS + b"\t" + bytes(range(65, 91)), b"\n" * len(_PIECE_ENDS) + b" " + bytes(range(97, 123))
)
_PAIR = np.uint64(0x9FB21C651E98DF25)


class Run:
    """Words of some texts of one language as numbers, with the words left in each one's piece."""

    def __init__(self) -> None:
        self._words: list[bytes] = []
        self._lengths: list[int] = []

    def add(self, text: str) -> None:
        for piece in text.encode("utf-8", "replace").translate(_CLEANED).split(b"\n"):
            words = piece.split(b" ")
            if b"" in words:
                words = [word for word in words if word]
            if words:
                self._words += words
                self._lengths.append(len(words))

    def __len__(self) -> int:
        return len(self._words)

    def numbered(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct words, number of each word, words from each to the end of its piece)."""
        encoded = pa.array(self._words, pa.binary()).dictionary_encode()
        ends = np.cumsum(self._lengths)
        left = np.repeat(ends, self._lengths) - np.arange(len(self._words))
        return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), left


def _word_hashes(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    return SliceHashes(data[: offsets[-1]]).of(offsets[:-1], offsets[1:])


def _pair_hashes(lang: str, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words of a language, from the words' hashes."""
    name = np.frombuffer(lang.encode(), dtype=np.uint8)
    salt = SliceHashes(name).of(np.array([0]), np.array([len(name)]))
    return mixed(one * _PAIR + two + salt)


def _joined(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    """Phrases of words by their numbers, parted by blanks; a number below 0 is no word."""
    parts = [words.take(pa.array(c, mask=c < 0)) for c in columns]
    joined = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, b" ", null_handling="skip")
    return joined.cast(pa.string())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Run]]:
    """Runs of about RUN_WORDS words out of batches (lang, text)."""
    open_runs: dict[str, Run] = {}
    size = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 64):
            part = batch.slice(begin, 64)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                run = open_runs.setdefault(lang, Run())
                before = len(run)
                run.add(text)
                size += len(run) - before
                if size >= RUN_WORDS:
                    yield from open_runs.items()
                    open_runs, size = {}, 0
    yield from open_runs.items()


def _short_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, words, phrase, n): words and pairs of a run; as phrase of 0 words, all of them."""
    for lang, run in _runs(batches):
        if not len(run):
            continue
        words, number, left = run.numbered()
        size = len(words)
        at = np.flatnonzero(left >= 2)
        pairs, times = np.unique(number[at] * size + number[at + 1], return_counts=True)
        for count, phrases, n in (
            (0, pa.array([""]), np.array([len(run)])),
            (1, words.cast(pa.string()), np.bincount(number, minlength=size)),
            (2, _joined(words, [pairs // size, pairs % size]), times),
        ):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), count, dtype=np.int32)), phrases, pa.array(n.astype(np.int64))],
                ["lang", "words", "phrase", "n"],
            )


class Filter:
    """Which positions of hashed pairs are frequent: may say yes wrongly, never no."""

    def __init__(self, bits: np.ndarray):
        self._bits = bits
        self._mask = np.uint64(8 * len(bits) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self._mask
        return (self._bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_pairs(pairs: DataFrame, count: int) -> Filter:
    """The filter of staged rows (lang, phrase) of two words; bits are set in tasks."""
    positions = min(MOST_POSITIONS, max(2**10, 2 ** math.ceil(math.log2(16 * count + 1))))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                own = batch.column(1).filter(pc.equal(batch.column(0), lang)).cast(pa.binary())
                parted = pc.list_flatten(pc.split_pattern(own, b" "))
                hashes = _word_hashes(pa.array(parted.to_pylist(), pa.binary()))
                at = _pair_hashes(lang, hashes[0::2], hashes[1::2]) & np.uint64(positions - 1)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], ["at"])

    words = (
        pairs.select("lang", "phrase")
        .mapInArrow(hashed, "at long")
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(positions // 64, dtype="<i8")
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return Filter(bits.view(np.uint8))


def _suffixes(lang: str, run: Run, frequent: Filter) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, n): distinct suffixes of a run as far as their pairs are frequent, of
    three to five words, with how often each occurs."""
    words, number, left = run.numbered()
    hashes = _word_hashes(words)
    linked = np.zeros(len(number), dtype=bool)
    at = np.flatnonzero(left >= 2)
    linked[at] = frequent.holds(_pair_hashes(lang, hashes[number[at]], hashes[number[at + 1]]))
    reach = np.ones(len(number), dtype=np.int64)
    chain = np.ones(len(number), dtype=bool)
    for step in range(LONGEST - 1):
        chain &= np.concatenate([linked[step:], np.zeros(min(step, len(linked)), dtype=bool)])
        reach += chain
    at = np.flatnonzero(reach >= 3)
    if not len(at):
        return
    # Names of ever longer prefixes; at last, one name per distinct suffix and its first place.
    names = number[at]
    size = len(words) + 1
    for step in range(1, LONGEST):
        inside = reach[at] > step
        following = np.where(inside, number[np.minimum(at + step, len(number) - 1)], size - 1)
        names = np.unique(names * size + following, return_inverse=True)[1]
    _, first, times = np.unique(names, return_index=True, return_counts=True)
    at = at[first]
    columns = [np.where(reach[at] > i, number[np.minimum(at + i, len(number) - 1)], -1) for i in range(LONGEST)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(at), pa.string()), _joined(words, columns), pa.array(times.astype(np.int64))], ["lang", "phrase", "n"]
    )


def frequent_prefixes(keys: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, length, weight) of every prefix of rows of `keys` that weighs at least `least`.

    Multikey three-way quicksort of pointers to rows: those whose key at the depth is below,
    equal to and above a pivot part; equal ones go on at the next depth, and their weight is
    the prefix's. Partitions that weigh less are abandoned. A key below 0 ends its row.
    """
    stack = [(np.arange(len(keys)), 0)]
    while stack:
        rows, depth = stack.pop()
        column = keys[rows, depth]
        # The median of three; the middle one of a sorted run halves it.
        pivot = sorted((column[0], column[len(column) // 2], column[-1]))[1]
        for part in (column < pivot, column > pivot):
            some = rows[part]
            if len(some) and weight[some].sum() >= least:
                stack.append((some, depth))
        same = rows[column == pivot]
        total = int(weight[same].sum())
        if pivot >= 0 and total >= least:
            yield int(same[0]), depth + 1, total
            if depth + 1 < keys.shape[1]:
                stack.append((same, depth + 1))


def _sorted_counts(least: int):
    """Counts of phrases of three words or more in groups of routed suffixes (route, lang, phrase, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "route"):
            if pc.sum(table.column("n")).as_py() < least:
                continue
            parted = pc.split_pattern(table.column("phrase").combine_chunks(), " ")
            flat = parted.flatten().dictionary_encode()
            lengths = np.diff(parted.offsets.to_numpy())
            row = np.repeat(np.arange(len(lengths)), lengths)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            langs = table.column("lang").combine_chunks().dictionary_encode()
            keys = np.full((len(lengths), LONGEST + 1), -1, dtype=np.int64)
            keys[:, 0] = langs.indices.to_numpy()
            keys[row, nth + 1] = flat.indices.to_numpy()
            # The language stands before the words, so that languages part first.
            found = [x for x in frequent_prefixes(keys, table.column("n").to_numpy(), least) if x[1] >= 4]
            if not found:
                continue
            first, length, n = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
            columns = [np.where(length > i + 1, keys[first, i + 1], -1) for i in range(LONGEST)]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(keys[first, 0])),
                    pa.array((length - 1).astype(np.int32)),
                    _joined(flat.dictionary.cast(pa.binary()), columns),
                    pa.array(n),
                ],
                ["lang", "words", "phrase", "n"],
            )

    return count


COUNTS = "lang string, words int, phrase string, n long"


def phrase_counts(spark: SparkSession, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Staged rows (lang, words, phrase, n): all phrases of one to five words that occur `least`
    times or more in their language, and one row of 0 words per language with all its words."""
    ship(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    summed = texts.mapInArrow(_short_counts, COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    short = staged(spark, summed.where((F.col("n") >= least) | (F.col("words") == 0)))
    pairs = short.where("words = 2")
    count = pairs.count()
    if not count:
        return short
    shared = spark.sparkContext.broadcast(frequent_pairs(pairs, count))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, run in _runs(batches):
            if len(run):
                yield from _suffixes(lang, run, shared.value)

    # Copies of a passage become one row before they meet in their route.
    distinct = texts.mapInArrow(suffixes, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    route = F.xxhash64("lang", F.substring_index("phrase", " ", 3)).alias("route")
    routed = distinct.select(route, "lang", "phrase", "n").repartition("route").sortWithinPartitions("route")
    return staged(spark, short.unionByName(routed.mapInArrow(_sorted_counts(least), COUNTS)))


def _whole_quotient(one: str, two: str) -> Column:
    """Exact floor of a quotient of products that may pass 64 bits."""
    return F.expr(f"({one}) div ({two})")


def scored_phrases(counts: DataFrame, scale: int = 1000) -> DataFrame:
    """Rows (lang, words, phrase, a, l, r, n, score) of the phrases of two words or more.

    Cut after its first k words, a phrase that occurs a times has parts that occur l and r times
    and the score floor(scale * a * n / (l * r)), n being all words of its language; the cut with
    the lowest score counts, ties go to the smallest k.
    """
    wide = counts.withColumn("n", F.col("n").cast("decimal(38,0)"))
    phrases = wide.where("words >= 2").withColumnRenamed("n", "a")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")}
    )
    part = wide.where("words >= 1")
    firsts = part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    totals = wide.where("words = 0").select("lang", "n")
    # One row per language; a language may hold most phrases, which a shuffle by it would gather.
    if totals.count() <= BROADCAST_KEYS:
        totals = F.broadcast(totals)
    scored = (
        cut.join(firsts, ["lang", "first"])
        .join(rests, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", _whole_quotient(f"CAST({scale} AS DECIMAL(38,0)) * a * n", "l * r"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "words", "phrase", "a", "n").agg(lowest).select(
        "lang", "words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def without_parts(phrases: DataFrame) -> DataFrame:
    """The phrases, less those that always stand inside one longer phrase of the table."""
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1),"
        " at -> array_join(slice(split(phrase, ' '), at, size), ' '))))"
    )
    inside = (
        phrases.where("words >= 3")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    joined = phrases.join(inside, ["lang", "phrase"], "left")
    return joined.where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True))).drop("longer")


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language by score,
    then count, then the phrase's bytes.

    A null text is an empty one, a null lang reads `und`. Words are runs of anything but blanks
    and tabs inside pieces; A-Z are lower-cased. Repeated rows count as often as they occur.
    Other columns are ignored. A table without frequent phrases gives no rows.
    """
    phrases = staged(spark, scored_phrases(phrase_counts(spark, docs, least)))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = without_parts(phrases).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    numbers = {c: F.col(c).cast("long") for c in ("rank", "a", "l", "r", "n", "score")}
    return ranked.withColumns(numbers).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
