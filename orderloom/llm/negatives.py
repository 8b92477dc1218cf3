"""Hard negatives by exact inner products of whole numbers, packed by Kronecker's substitution.

Inside a task the j-th components of many candidates stand in separate fields of one wide
integer. An anchor multiplies each of its components once with such an integer and adds up;
the fields of the sum are then the candidates' inner products. Components are biased to be
non-negative and fields are wide enough for any sum, so nothing carries over and every score
is exact.
"""

from __future__ import annotations

from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import ship, staged

SCALE = 256
#: Candidates and anchors of one task at most.
BLOCK = 65_536
#: Candidates of one task at least, as long as there are fewer tasks than four per core.
LEAST_BLOCK = 512
#: Candidates in one wide integer, few enough that it stays in the caches.
PACKED = 2048
#: Rows with a larger sum of squares take no part: their scores may not fit a long.
MOST_SQUARES = 2.0**62

_CELL = ["dimension", "anchor_block", "block"]


def whole_components(vector: Column, scale: int = SCALE) -> Column:
    """Each component as the whole number below `scale` times its double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column, label: Column) -> Column:
    """True for rows with a label and a vector of finite components that is not empty."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return label.isNotNull() & F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


class Packed:
    """Candidates as wide integers, one per component and PACKED candidates."""

    def __init__(self, components: np.ndarray):
        self._bias = max(0, -int(components.min()))
        self._most = int(components.max()) + self._bias
        self._components = components
        self._sums = components.sum(axis=1, dtype=np.int64)
        self._width = 0
        self._groups: list[tuple[int, list[int]]] = []

    def fit(self, most_factor: int) -> None:
        """Make fields wide enough for sums of products with factors up to `most_factor`."""
        dimension = self._components.shape[1]
        bits = (dimension * self._most * most_factor).bit_length()
        self._width = next(w for w in (4, 8, 16, 24) if 8 * w >= bits)
        biased = (self._components + self._bias).astype("<u8")
        for begin in range(0, len(biased), PACKED):
            part = biased[begin : begin + PACKED]
            fields = np.zeros((dimension, len(part), self._width), dtype=np.uint8)
            kept = min(8, self._width)
            fields[:, :, :kept] = np.ascontiguousarray(part.T).view(np.uint8).reshape(dimension, len(part), 8)[:, :, :kept]
            self._groups.append((len(part), [int.from_bytes(f.tobytes(), "little") for f in fields]))

    def scores(self, factors: np.ndarray, bias: int) -> np.ndarray:
        """The inner product of every candidate with the anchor `factors`, which `bias` lifts above 0."""
        lifted = [int(x) + bias for x in factors]
        out = []
        for count, wide in self._groups:
            total = sum(map(mul, wide, lifted)).to_bytes(count * self._width, "little")
            if self._width == 4:
                out.append(np.frombuffer(total, dtype="<u4").astype(np.uint64))
            else:
                out.append(np.frombuffer(total, dtype="<u8")[:: self._width // 8])
        # The bias is taken off modulo 2**64; the score itself fits a long.
        factor_sum = int(factors.sum()) % 2**64
        same = (self._bias * factor_sum + len(lifted) * self._bias * bias) % 2**64
        lift = self._sums.astype(np.uint64) * np.uint64(bias % 2**64)
        return (np.concatenate(out) - lift - np.uint64(same)).view(np.int64)


def _matrix(rows: pa.Table) -> np.ndarray:
    return rows.column("components").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def _best(scores: np.ndarray, wanted: np.ndarray, count: int) -> np.ndarray:
    """Positions of the highest wanted scores, ties in the order of positions."""
    at = np.flatnonzero(wanted)
    if len(at) > count:
        own = scores[at]
        at = at[own >= np.partition(own, len(own) - count)[len(own) - count]]
    return at[np.argsort(-scores[at], kind="stable")][:count]


def _scored(anchors: pa.Table, candidates: pa.Table):
    """(position of the anchor, its scores, which candidates have its label) and the candidates,
    in order of their ids; ids that are null come last."""
    ids = candidates.column("id").to_numpy(zero_copy_only=False)
    place = candidates.column("place").to_numpy()
    missing = np.asarray(candidates.column("id").is_null())
    order = np.lexsort((place, np.where(missing, 0, ids).astype(np.int64), missing))
    candidates = candidates.take(pa.array(order))
    labels = pa.chunked_array([*anchors.column("label").chunks, *candidates.column("label").chunks]).combine_chunks()
    codes = labels.dictionary_encode().indices.to_numpy()
    factors = _matrix(anchors)
    bias = max(0, -int(factors.min()))
    packed = Packed(_matrix(candidates))
    packed.fit(int(factors.max()) + bias)

    def each():
        for i, row in enumerate(factors):
            yield i, packed.scores(row, bias), codes[len(factors) :] == codes[i]

    return each(), candidates


def _out(columns: dict[str, list], candidates: pa.Table, rows: list[np.ndarray], values: list[np.ndarray]) -> pa.Table:
    at = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    chosen = candidates.take(pa.array(at))
    named = {name: pa.array(value, kind) for name, (value, kind) in columns.items()}
    scores = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
    found = {"place": chosen.column("place"), "id": chosen.column("id"), "score": pa.array(scores, pa.int64())}
    return pa.table({**named, **found})


def _positives_of(count: int):
    def compare(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return _out({"anchor": ([], pa.int64())}, candidates, [], [])
        scored, candidates = _scored(anchors, candidates)
        own, place = anchors.column("place").to_numpy(), candidates.column("place").to_numpy()
        anchor, rows, values = [], [], []
        for i, scores, alike in scored:
            best = _best(scores, alike & (place != own[i]), count)
            anchor += [own[i]] * len(best)
            rows.append(best)
            values.append(scores[best])
        return _out({"anchor": (anchor, pa.int64())}, candidates, rows, values)

    return compare


def _negatives_of(count: int, low: int, high: int):
    def compare(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return _out({"anchor": ([], pa.int64()), "positive": ([], pa.int64())}, candidates, [], [])
        scored, candidates = _scored(anchors, candidates)
        own, bounds = anchors.column("place").to_numpy(), anchors.column("positives").to_pylist()
        anchor, positive, rows, values = [], [], [], []
        for i, scores, alike in scored:
            for at in bounds[i]:
                # Whole numbers: low * p <= 100 * n <= high * p.
                least, most = -(-low * at["score"] // 100), high * at["score"] // 100
                best = _best(scores, ~alike & (scores >= least) & (scores <= most), count)
                anchor += [own[i]] * len(best)
                positive += [at["place"]] * len(best)
                rows.append(best)
                values.append(scores[best])
        return _out({"anchor": (anchor, pa.int64()), "positive": (positive, pa.int64())}, candidates, rows, values)

    return compare


def _block_counts(rows: DataFrame, parallelism: int) -> DataFrame:
    """Blocks of candidates and of anchors per dimension, for dimensions that have an anchor."""
    sizes = rows.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("a"))
    parallel = F.least(F.ceil(F.col("n") / LEAST_BLOCK), F.lit(4 * parallelism).cast("long"))
    return sizes.where("a > 0").select(
        "dimension",
        F.greatest(F.ceil(F.col("n") / BLOCK), parallel).alias("blocks"),
        F.ceil(F.col("a") / BLOCK).alias("anchor_blocks"),
    )


def _compared(anchors: DataFrame, candidates: DataFrame, compare, schema: str) -> DataFrame:
    """Every block of anchors beside every block of candidates of its dimension, a pair to a task."""
    left = anchors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    right = candidates.withColumn(
        "anchor_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("anchor_blocks") - 1))
    )
    # Both come from one table; new names for the columns of one side tell them apart.
    left = left.select(*(F.col(c).alias(c) for c in left.columns))
    return left.groupBy(*_CELL).cogroup(right.groupBy(*_CELL)).applyInArrow(compare, schema)


def hard_negatives(
    spark: SparkSession,
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has (id, label, embedding). An anchor's positives are the other rows of its label
    with the highest scores; its negatives for a positive of score p are the rows of other
    labels whose score n has low * p <= 100 * n <= high * p, the highest first. Ties go to the
    smaller id, a null one last. A score is the inner product of `whole_components`; vectors of
    different lengths have none.

    Rows without label or vector, with an empty vector or a null or non-finite component take
    no part, nor do those whose sum of squares passes MOST_SQUARES. Rows that repeat an id are
    rows of their own. Other columns are ignored; without rows or anchors the result is empty.

    Anchors are compared with all rows in pairs of blocks dealt by hash, so no label, id or
    vector that many rows share makes a large task; only the best of each pair are shuffled.
    """
    ship(spark)
    kept = rows.where(usable(F.col("embedding"), F.col("label"))).select(
        F.col("id").cast("long").alias("id"),
        F.col("label").cast("string").alias("label"),
        whole_components(F.col("embedding")).alias("components"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    squares = F.aggregate("components", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = kept.where(squares < MOST_SQUARES).withColumns(
        {"place": F.monotonically_increasing_id(), "dimension": F.size("components")}
    )
    kept = staged(spark, kept)
    counts = _block_counts(kept, spark.sparkContext.defaultParallelism)
    dealt = kept.join(counts, "dimension")
    hashed = F.xxhash64("place")
    wide = ["place", "id", "label", "components", "dimension"]
    candidates = dealt.select(*wide, "anchor_blocks", F.pmod(hashed, "blocks").alias("block"))
    anchors = dealt.where("is_anchor").select(*wide, "blocks", F.pmod(hashed, "anchor_blocks").alias("anchor_block"))

    found = _compared(anchors, candidates, _positives_of(positives), "anchor long, place long, id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "place")
    best = staged(spark, found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives))
    bounds = best.groupBy(F.col("anchor").alias("place")).agg(F.collect_list(F.struct("place", "score")).alias("positives"))

    found = _compared(
        anchors.join(bounds, "place"),
        candidates,
        _negatives_of(negatives, low, high),
        "anchor long, positive long, place long, id long, score long",
    )
    first = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "place")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    named = best.select("anchor", F.col("place").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    anchor_ids = kept.where("is_anchor").select(F.col("place").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        ranked.select("anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(named, ["anchor", "positive"])
        .join(anchor_ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def mined_digest(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Hard negatives of rows (vec_id, embedding, label): anchors have ids divisible by 100, and
    where an id is divisible by 7 the label is first moved on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").alias("id"), moved.alias("label"), "embedding")
    return hard_negatives(spark, rows, F.col("id") % 100 == 0)
