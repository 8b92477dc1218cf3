"""Packing by non-negative least squares over shallow combinations of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import numbered, ship, staged
from orderloom.llm.tokens import chunks, default_vocabulary, encoder

WINDOW = 1024
#: Of a task's encoder: fewer than its default, as packing may share its workers with other stages.
PARTS_KEPT = 250_000
#: Whole batches, mostly: of the texts that are encoded at once each distinct part is looked up once.
CHARS_AT_ONCE = 4_000_000
Packing = list[tuple[tuple[int, ...], int]]

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """Multisets of one to three of the lengths that fill the window, ascending, 0 for none."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    first, second = np.meshgrid(lengths, lengths, indexing="ij")
    third = window - first - second
    full = (first <= second) & (second <= third)
    full[full] = there[third[full]]
    triples = np.stack([first[full], second[full], third[full]], axis=1)
    low = lengths[(2 * lengths <= window) & there[np.clip(window - lengths, 0, window)]]
    pairs = np.stack([np.zeros_like(low), low, window - low], axis=1)
    single = np.array([[0, 0, window]] if there[window] else [], dtype=lengths.dtype).reshape(-1, 3)
    return np.concatenate([single, pairs, triples])


def non_negative_least_squares(parts: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeats x >= 0 that minimise |A x - counts|, by accelerated projected gradient steps.

    Column i of A counts the lengths in parts[i]; length 0 does not count.
    """
    bins = len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        total = np.bincount(parts.ravel(), weights=np.repeat(x, parts.shape[1]), minlength=bins)
        total[0] = 0
        return total

    def gradient(rest: np.ndarray) -> np.ndarray:
        return rest[parts].sum(axis=1)

    direction = np.ones(len(parts))
    for _ in range(20):
        direction = gradient(used(direction))
        step = np.linalg.norm(direction)
        direction /= step
    x = ahead = np.zeros(len(parts))
    momentum = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, ahead - gradient(used(ahead) - counts) / (1.05 * step))
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / later * (new - x)
        x, momentum = new, later
    return x


def pack_histogram(counts: np.ndarray) -> Packing:
    """Combinations of lengths with their repeats, which use every piece once.

    counts[n] pieces have length n; the window is the largest length. Work and memory
    depend on the window alone, never on the number of pieces.
    """
    window = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan: Packing = []
    lengths = np.flatnonzero(left)
    parts = combinations(window, lengths) if len(lengths) else np.zeros((0, 3), dtype=np.int64)
    if len(parts):
        repeats = np.rint(non_negative_least_squares(parts, left.astype(float))).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if repeats[i] < 1:
                break
            combination = tuple(int(n) for n in parts[i][::-1] if n)
            times = min(int(repeats[i]), *(int(left[n]) // combination.count(n) for n in set(combination)))
            if times:
                plan.append((combination, times))
                for n in combination:
                    left[n] -= times
    while left.any():
        combination, space, free = [], window, left.copy()
        while space and (fits := np.flatnonzero(free[: space + 1])).size:
            n = int(fits[-1])
            fill = min(space // n, int(free[n]))
            combination += [n] * fill
            free[n] -= fill
            space -= n * fill
        times = min(int(left[n]) // combination.count(n) for n in set(combination))
        plan.append((tuple(combination), times))
        for n in combination:
            left[n] -= times
    return plan


def places(plan: Packing, window: int) -> dict[int, np.ndarray]:
    """For each length, columns (first rank, first sequence, offset) in order of rank.

    The pieces of one length fill the slots of that length in order of rank.
    """
    taken = [0] * (window + 1)
    out: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for combination, times in plan:
        offset = 0
        for length in combination:
            out.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {length: np.array(rows, dtype=np.int64).T for length, rows in out.items()}


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int) -> DataFrame:
    """Rows of PIECES: each document's ids with the end id, cut after every full window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, PARTS_KEPT).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            at = 0
            for texts in chunks(batch.column(1), CHARS_AT_ONCE):
                rows = []
                for data in encode(texts):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        piece = data[4 * start : 4 * (start + window)]
                        rows.append((ids[at], start, len(piece) // 4, zlib.crc32(piece), total))
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack_documents(
    spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, window: int = WINDOW
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one per piece.

    A null text is an empty one: its only id is the end id. Repeated rows and rows without
    doc_id are documents of their own. An empty table gives no rows; columns other than
    doc_id and text are ignored. No document meets another but in the histogram of piece
    lengths, one count per length; pieces find their places by their rank in their length,
    counted per input split, so that one frequent length is no hot key.
    """
    ship(spark)
    pieces = staged(
        spark,
        cut_pieces(docs, vocabulary or default_vocabulary(), end_id, window).withColumn(
            "place", F.monotonically_increasing_id()
        ),
    )
    counts = np.zeros(window + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    table = places(pack_histogram(counts), window)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(2).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                first, base, inside = table[int(n)]
                slot = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = base[slot] + rank[own] - first[slot]
                offset[own] = inside[slot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    ranked = numbered(pieces, "length", "rank").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"
    )
    return ranked.mapInArrow(placed, f"{PIECES}, sequence_id long, offset long")
