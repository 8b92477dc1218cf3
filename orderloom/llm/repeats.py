"""Repeated byte strings across a corpus by depth-limited radix passes over sampled suffixes.

Only whether the first WINDOW bytes of a suffix occur again matters, so suffixes are ordered
through that depth alone, most significant digit first, and a suffix that is alone in its
group after some digit leaves. The digits of a suffix are

1. the ANCHOR bytes in it with the smallest hash, and where they stand: a digit that runs of
   neighbouring suffixes share, so that a pass needs one row per run, not one per byte;
2. all bytes of the run's suffixes, which settles runs that occur again as a whole;
3. for what is left, the bytes of each suffix, DIGIT at a time, inside the group of its anchor.

Groups of two or more after the last digit are exactly the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.bytehash import SliceHashes, mixed, sliding_min
from orderloom.llm.common import picked, ship, staged, text_or_empty, whole_groups
from orderloom.llm.tokens import forget

WINDOW = 200
ANCHOR = 48
DIGIT = 50
#: Anchors with more different runs than this (about 3 MB of text) are sorted by Spark, suffix by suffix.
MOST_RUNS = 8192

_LOW = np.uint64(0xFFFFFFFF)


def anchored_runs(data: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, run hash, first start, last start, anchor place) of each run of windows.

    A window's anchor is its slice of ANCHOR bytes with the smallest hash, the leftmost of
    equal ones; windows with one anchor follow each other. Equal windows have equal anchors at
    equal offsets, wherever they stand.
    """
    hashes = SliceHashes(data)
    slices = hashes.windows(ANCHOR)
    ordered = (slices & ~_LOW) | np.arange(len(slices), dtype=np.uint64)
    chosen = (sliding_min(ordered, window - ANCHOR + 1) & _LOW).astype(np.int64)
    cuts = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [len(chosen)]]) - 1
    place = chosen[first]
    whole = mixed(hashes.of(first, last + window) + (place - first).astype(np.uint64))
    return slices[place], whole, first, last, place


def _pack(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A run's place in its text: both differences are below the window of 200."""
    return (first << 16) | ((place - first) << 8) | (last - first)


def _unpack(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = run >> 16
    return first, first + (run & 0xFF), first + ((run >> 8) & 0xFF)


def _bytes_of(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def _all_runs(texts: DataFrame, window: int) -> DataFrame:
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], [], []]
            size = 0
            for key, data in zip(batch.column(0).to_numpy(), _bytes_of(batch.column(1)), strict=True):
                if len(data) < window:
                    continue
                anchor, whole, first, last, place = anchored_runs(np.frombuffer(data, dtype=np.uint8), window)
                for column, values in zip(found, (np.full(len(first), key), anchor.view(np.int64), whole.view(np.int64), _pack(first, last, place)), strict=True):
                    column.append(values)
                size += len(first)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], ["doc", "anchor", "whole", "run"])
                    found, size = [[], [], [], []], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], ["doc", "anchor", "whole", "run"])

    return texts.select("doc", "text").mapInArrow(runs, "doc long, anchor long, whole long, run long")


def repeated_starts(anchor: np.ndarray, run: np.ndarray, pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of the windows of runs that another run with the same anchor has too.

    Each pass takes the next DIGIT bytes of all windows that are left and drops those whose
    group, by anchor, offset and all digits so far, has one member.
    """
    first, last, place = _unpack(run)
    hashes = SliceHashes(np.frombuffer(b"".join(pieces), dtype=np.uint8))
    base = np.cumsum([0, *map(len, pieces)])[:-1]
    count = last - first + 1
    row = np.repeat(np.arange(len(run)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = base[row] + step
    group = mixed(anchor.view(np.uint64)[row] + ((place - first)[row] - step).astype(np.uint64))
    for depth in range(0, window, DIGIT):
        digit = hashes.of(at + depth, at + min(depth + DIGIT, window))
        group = mixed(group + digit * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(group)
        same = group[order][1:] == group[order][:-1]
        kept = np.sort(order[np.concatenate([same, [False]]) | np.concatenate([[False], same])])
        row, step, at, group = row[kept], step[kept], at[kept], group[kept]
        if not len(row):
            break
    return row, first[row] + step


def _stretches(row: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes that consecutive windows of a row cover."""
    if not len(row):
        return row, start, start
    cut = np.flatnonzero((row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    begin = np.concatenate([[0], cut])
    end = np.concatenate([cut, [len(row)]]) - 1
    return row[begin], start[begin], start[end] + window


def _parts(tables: Iterator[pa.Table], rows: int) -> Iterator[pa.Table]:
    """The tables in parts of whole groups by anchor, each of so many rows or of one group."""
    for table in tables:
        anchor = table.column("anchor").to_numpy()
        ends = [*(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(anchor)]
        begin = 0
        for end, following in zip(ends, [*ends[1:], np.inf], strict=True):
            if following - begin > rows:
                yield table.slice(begin, end - begin)
                begin = end


def repeated_stretches(spark: SparkSession, texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc, start, stop) of bytes covered by strings of `window` bytes that start elsewhere too.

    `texts` has rows (doc, text); rows with the same `doc` must have the same text and count
    each. Stretches of a text may overlap.
    """
    ship(spark)
    runs = staged(spark, _all_runs(texts, window))
    # Written, so that the join has a plain exchange on either side and splits a hot anchor.
    often = staged(spark, runs.groupBy("anchor").count().where("count > 1").select("anchor"))
    runs = staged(spark, runs.join(often, "anchor"))
    wholes = staged(
        spark,
        runs.groupBy("anchor", "whole").agg(
            F.count(F.lit(1)).alias("times"), F.min("doc").alias("doc"), F.min_by("run", "doc").alias("run")
        ),
    )
    start = F.shiftright("run", 16)
    stop = start + F.col("run").bitwiseAND(0xFF) + window
    settled = runs.join(wholes.where("times > 1").select("anchor", "whole"), ["anchor", "whole"]).select(
        "doc", start.alias("start"), stop.alias("stop")
    )
    varied = wholes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    item = F.struct("anchor", "run", "times", (F.col("kinds") > MOST_RUNS).alias("many"))
    items = staged(
        spark, wholes.join(varied, "anchor").groupBy("doc").agg(F.collect_list(item).alias("items"))
    )
    needed = picked(texts.select("doc", "text"), items.select("doc"), "doc").dropDuplicates(["doc"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(_bytes_of(batch.column(1))):
                item = batch.column(2)[i].values
                run = item.field("run").to_numpy()
                first, last, _ = _unpack(run)
                pieces = [data[a:b] for a, b in zip(first.tolist(), (last + window).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(run), batch.column(0)[i].as_py())),
                        item.field("anchor"),
                        item.field("run"),
                        item.field("times"),
                        item.field("many"),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["doc", "anchor", "run", "times", "many", "piece"],
                )

    pieces = staged(
        spark,
        needed.join(items, "doc")
        .select("doc", "text", "items")
        .mapInArrow(cut, "doc long, anchor long, run long, times long, many boolean, piece binary"),
    )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _parts(whole_groups(batches, "anchor"), 2000):
            doc, times = rows.column("doc").to_numpy(), rows.column("times").to_numpy()
            data = rows.column("piece").to_pylist()
            row, at = repeated_starts(rows.column("anchor").to_numpy(), rows.column("run").to_numpy(), data, window)
            open_ = times[row] == 1  # runs that occur again as a whole are settled
            row, begin, end = _stretches(row[open_], at[open_], window)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[row], begin, end)], ["doc", "start", "stop"])

    grouped = pieces.where("NOT many").repartition("anchor").sortWithinPartitions("anchor")
    sorted_ = grouped.mapInArrow(sort, "doc long, start long, stop long")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                rows = batch.slice(begin, 2000)
                first, last, _ = _unpack(rows.column(1).to_numpy())
                data = rows.column(3).to_pylist()
                hashes = SliceHashes(np.frombuffer(b"".join(data), dtype=np.uint8))
                count = last - first + 1
                row = np.repeat(np.arange(len(count)), count)
                step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = np.cumsum([0, *map(len, data)])[:-1][row] + step
                columns = (rows.column(0).to_numpy()[row], first[row] + step, rows.column(2).to_numpy()[row], hashes.of(at, at + window).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "start", "times", "string"])

    strings = pieces.where("many").select("doc", "run", "times", "piece").mapInArrow(
        explode, "doc long, start long, times long, string long"
    )
    again = strings.groupBy("string").count().where("count > 1").select("string")
    counted = strings.where("times = 1").join(again, "string").select("doc", "start", (F.col("start") + window).alias("stop"))
    return settled.unionByName(sorted_).unionByName(counted)


def _removed(data: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without the stretches, bytes removed, and maximal runs of them."""
    change = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, stop, -1)
    gone = np.cumsum(change[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def without_repeats(
    spark: SparkSession, docs: DataFrame, window: int = WINDOW, characters: bool = False
) -> DataFrame:
    """Rows (row, n_bytes, n_removed, n_spans, kept): `kept` are the UTF-8 bytes that stay, null if all do.

    Each byte covered by a string of `window` bytes that also starts anywhere else, in the
    same text too, is removed; strings are judged on the input and never cross texts. A null
    text is an empty one. Repeated rows lose all that is covered, the first one too. An empty
    table gives no rows; all columns stay in `row`. With `characters`, bytes of a character
    that is removed in part go as well, and `kept` is valid UTF-8; the counts stay those of
    the covered bytes.
    """
    ship(spark)
    rows = docs.select(
        F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("doc"), text_or_empty().alias("text")
    )
    # Repeated rows share a `doc`: their equal stretches count once.
    stretches = repeated_stretches(spark, rows.select("doc", "text"), window).dropDuplicates(["doc", "start", "stop"])
    gathered = staged(
        spark, stretches.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))
    )
    size = F.octet_length("text").cast("long")
    zero = F.lit(0).cast("long")
    whole = picked(rows, gathered.select("doc"), "doc", "left_anti").select(
        "row", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept")
    )
    touched = picked(rows, gathered.select("doc"), "doc").join(gathered, "doc").select("row", "text", "stretches")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, data in enumerate(_bytes_of(batch.column(1))):
                stretch = batch.column(2)[i].values
                kept, removed, spans = _removed(data, stretch.field("start").to_numpy(), stretch.field("stop").to_numpy())
                if characters:
                    kept = kept.decode("utf-8", "ignore").encode("utf-8")
                out.append((len(data), removed, spans, kept))
            sizes, removed, spans, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                ["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"
    return whole.unionByName(touched.mapInArrow(remove, schema))


def repeats_digest(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per document."""
    left = F.coalesce("kept", F.coalesce(F.col("row.text"), F.lit("")).cast("binary"))
    return without_repeats(spark, docs.select("doc_id", "text"), window).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2(left, 256).alias("kept_sha256")
    )


def drop_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without their repeated bytes, whole characters only, columns as they came."""
    kept = F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.col("kept").cast("string"))
    rows = without_repeats(spark, docs, window, characters=True).withColumn("clean", kept)
    return rows.select(*(F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
