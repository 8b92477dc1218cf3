"""Near-duplicate vectors by iterative quantisation, multi-index tables and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import connected, lowest_reached, ship, staged

#: Rotations are learned from at most about so many vectors; every vector is indexed.
SAMPLE = 20_000
LEAST_COSINE = 0.95
#: Wanted chance that a pair at the least cosine meets in some table.
RECALL = 0.995
#: Rows of a bucket that one task compares with one another; larger buckets are cut into
#: blocks, and every pair of blocks is a group of its own.
BLOCK = 512
ITQ_ROUNDS = 30
#: Bits of the sketch that candidates are compared by before their vectors are fetched.
SKETCH_BITS = 128
#: Buckets are made larger, down to one of all vectors, where the recall would take more tables.
MOST_TABLES = 64
#: The share of the probe pairs, those at the widest angles, that must meet with the recall.
WIDEST = 0.1
#: Vectors of the sample that probe pairs are made of; a fifth of them look for links in it.
PROBED = 5000


def learned_rotations(sample: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the sample and `count` rotations for balanced binary codes, side by side.

    Each starts from another random rotation of the principal axes and alternates between
    the nearest signs and the orthogonal map that brings the data closest to them.
    """
    dimension = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(dimension))
    projected = centred @ axes
    random = np.random.default_rng(dimension)
    out = [np.zeros((dimension, 0))]
    for _ in range(count):
        rotation, _ = np.linalg.qr(random.normal(size=(dimension, dimension)))
        for _ in range(ITQ_ROUNDS):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            rotation = left @ right
        out.append(axes @ rotation)
    return mean, np.concatenate(out, axis=1)


def random_rotations(dimension: int, bits: int, seed: int) -> np.ndarray:
    """At least so many directions, one random rotation after another, side by side."""
    random = np.random.default_rng([dimension, seed])
    turns = [np.linalg.qr(random.normal(size=(dimension, dimension)))[0] for _ in range(-(-bits // dimension))]
    return np.concatenate(turns, axis=1)


def probe_pairs(sample: np.ndarray, mean: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of unit vectors at the cosine or above, and the chance that each agrees in a bit of
    its code.

    PROBED vectors of the sample are paired with one towards another of the sample and one in
    a random direction, both at the cosine; as many pairs at most are links inside the sample.
    Codes are signs of the centred vectors, whose angle is wider the nearer a pair is to the
    mean; of made and of found pairs the WIDEST share is given.
    """
    random = np.random.default_rng(len(sample))
    sample = sample[random.permutation(len(sample))]
    some = sample[:PROBED]
    one = np.concatenate([some, some])
    aside = np.concatenate([np.roll(sample, 1, axis=0)[:PROBED], random.normal(size=some.shape)])
    aside = aside - (aside * one).sum(axis=1, keepdims=True) * one
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    # A vector that has no other direction is paired with itself.
    other = np.where(length > 1e-9, cosine * one + math.sqrt(1 - cosine**2) * aside / np.maximum(length, 1e-9), one)
    at, partner = np.nonzero(np.triu(sample[: PROBED // 5] @ sample.T >= cosine, 1))
    found = random.permutation(len(at))[:PROBED]
    at, partner = at[found], partner[found]
    made = len(one)
    one, other = np.concatenate([one, sample[at]]), np.concatenate([other, sample[partner]])
    a, b = one - mean, other - mean
    lengths = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    centred = np.where(lengths > 0, (a * b).sum(axis=1) / np.where(lengths > 0, lengths, 1), -1)
    agree = 1 - np.arccos(np.clip(centred, -1, 1)) / math.pi
    kinds = (np.arange(made), np.arange(made, len(agree)))
    widest = np.concatenate([x[np.argsort(agree[x], kind="stable")[: math.ceil(WIDEST * len(x))]] for x in kinds])
    return one[widest], other[widest], agree[widest]


def table_shape(vectors: int, agree: np.ndarray, recall: float = RECALL) -> tuple[int, int]:
    """Bits per table and number of tables for so many vectors, by the chances that pairs
    at the least cosine agree in a bit.

    A table has about as many buckets as there are vectors, or fewer where that takes more
    than MOST_TABLES tables; at 0 bits the one table has one bucket and finds every pair.
    """
    bits = min(30, max(8, math.ceil(math.log2(max(vectors, 2)))))
    while bits:
        apart = 1 - agree**bits
        for tables in range(1, MOST_TABLES + 1):
            if 1 - (apart**tables).mean() >= recall:
                return bits, tables
        bits -= 1
    return 0, 1


def measured_recall(one: np.ndarray, other: np.ndarray, mean: np.ndarray, rotations: np.ndarray, bits: int, tables: int) -> float:
    """The share of pairs whose codes agree in some table."""
    same = _codes(one, mean, rotations, bits, tables) == _codes(other, mean, rotations, bits, tables)
    return float(same.any(axis=1).mean())


def learned_tables(sample: np.ndarray, vectors: int, cosine: float, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Mean, rotations, bits per table and tables that find probe pairs with the recall.

    Learned rotations of few dimensions are much alike; where the measured recall falls
    short for that, tables of random rotations are added until it is reached.
    """
    dimension = sample.shape[1]
    one, other, agree = probe_pairs(sample, sample.mean(axis=0), cosine)
    bits, tables = table_shape(vectors, agree, recall)
    mean, rotations = learned_rotations(sample, -(-bits * tables // dimension))
    rotations = rotations[:, : bits * tables]
    while measured_recall(one, other, mean, rotations, bits, tables) < recall:
        more = -(-tables // 8)
        extra = random_rotations(dimension, bits * more, tables)[:, : bits * more]
        rotations, tables = np.concatenate([rotations, extra], axis=1), tables + more
    return mean, rotations, bits, tables


def _unit(values: pa.Array, dimension: int) -> np.ndarray:
    rows = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _codes(units: np.ndarray, mean: np.ndarray, rotations: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One integer of `bits` bits per vector and table."""
    flags = (units - mean) @ rotations[:, : bits * tables] >= 0
    return flags.reshape(len(units), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups (equal `bucket`, `cell`) of sorted batches; a group has at most two blocks."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        key = _key(rows)
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        if len(cuts):
            yield rows.slice(0, int(cuts[-1])).combine_chunks()
            rows = rows.slice(int(cuts[-1]))
        rest = rows
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _key(rows: pa.Table) -> np.ndarray:
    return rows.column("bucket").to_numpy() * 1_000_003 + rows.column("cell").to_numpy()


def in_blocks(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of buckets with two rows or more, once for each cell of blocks they are in.

    A bucket of n rows has ceil(n / BLOCK) blocks by hashed node; cell (i, j), i <= j, brings
    blocks i and j together, so that all pairs of a bucket meet and no task gets more than
    two blocks of it. Sorted by bucket and cell inside partitions.
    """
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK)
    mine = F.pmod(F.xxhash64("node"), blocks)
    cell = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda j: F.least(mine, j) * blocks + F.greatest(mine, j))
    cut = rows.join(sizes, "bucket").withColumns({"block": mine, "blocks": blocks}).withColumn("cell", F.explode(cell)).drop("n")
    return cut.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")


def near_vectors(
    spark: SparkSession,
    vectors: DataFrame,
    least: float = LEAST_COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of `vectors` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing; neither do vectors of different lengths. Equal vectors link with each other and
    are compared with others once, so a vector that a third of all rows repeat costs one.
    Candidates agree in one table of their codes; a link is a cosine of at least `least` in
    double precision. `n_links` counts rows, repeated vec_ids too; a component is named by its
    smallest vec_id, nulls last. Other columns are ignored; an empty table gives no rows.
    """
    ship(spark)
    usable = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    keyed = plain.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding")).select(
        "vec_id", "embedding", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")).alias("node")
    )
    members = staged(spark, keyed.select("vec_id", "node"))
    classes = staged(
        spark,
        keyed.where("node IS NOT NULL")
        .groupBy("node", F.col("embedding").alias("embedding"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("node", "copies", F.size("embedding").alias("dimension"), "embedding"),
    )
    counts = {row["dimension"]: row["count"] for row in classes.groupBy("dimension").count().collect()}
    parts = [
        _linked(spark, classes.where(F.col("dimension") == dimension), dimension, count, least, recall)
        for dimension, count in sorted(counts.items())
        if count > 1
    ]
    copies = classes.select("node", (F.col("copies") - 1).alias("links"))
    if not parts:
        linked, roots = copies, None
    else:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        found = staged(spark, found)
        linked = found.select("node", "links").unionByName(copies)
        roots = connected(spark, found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = linked.groupBy("node").agg(F.sum("links").alias("n_links"))
    rows = members.join(totals, "node", "left")
    if roots is not None:
        rows = rows.join(roots, "node", "left")
    else:
        rows = rows.withColumn("root", F.lit(None).cast("long"))
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    smallest = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("least_id"))
    named = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least_id"))
    return (
        rows.join(smallest, "root", "left")
        .withColumn("component_id", named)
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def _linked(
    spark: SparkSession, classes: DataFrame, dimension: int, count: int, least: float, recall: float
) -> DataFrame:
    """Rows (node, links, root) of classes of one dimension: links counted in one cell of one
    table, root the smallest node that it reaches there."""
    chosen = classes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(2**20)) < math.ceil(min(1.0, SAMPLE / count) * 2**20))
    sample = _unit(chosen.select("embedding").toArrow().column(0).combine_chunks(), dimension)
    if not len(sample):
        sample = np.eye(dimension)
    mean, rotations, bits, tables = learned_tables(sample, count, least, recall)
    # Sketches are of the vectors as they are, so their bits differ by the plain angle.
    turned = random_rotations(dimension, SKETCH_BITS, 0)[:, :SKETCH_BITS]
    shared = spark.sparkContext.broadcast((mean, rotations, turned))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, rotations, turned = shared.value
            units = _unit(batch.column(1), dimension)
            codes = _codes(units, mean, rotations, bits, tables)
            s1, s2 = np.packbits(units @ turned >= 0, axis=1).view(np.int64).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.FixedSizeListArray.from_arrays(pa.array(codes.astype(np.int32).ravel()), tables).cast(pa.list_(pa.int32())),
                    pa.array(s1.copy()),
                    pa.array(s2.copy()),
                ],
                ["node", "codes", "s1", "s2"],
            )

    coded = staged(spark, classes.select("node", "embedding").mapInArrow(encode, "node long, codes array<int>, s1 long, s2 long"))
    at = F.posexplode("codes").alias("table", "code")
    bucketed = coded.select("node", "s1", "s2", at).withColumn("bucket", F.col("table").cast("long") * 2**bits + F.col("code"))

    def near_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (bucket, node) that have a partner in their cell whose sketches are near."""
        most = _most_different(SKETCH_BITS, least)
        for rows in _groups(batches):
            key, node = _key(rows), rows.column("node").to_numpy()
            # Unsigned, since bits are counted in absolute values.
            s1, s2 = (rows.column(name).to_numpy().view(np.uint64) for name in ("s1", "s2"))
            near = np.zeros(len(key), dtype=bool)
            left = np.arange(len(key))
            step = 1
            while True:
                left = left[left + step < len(key)]
                left = left[key[left] == key[left + step]]
                if not len(left):
                    break
                apart = np.bitwise_count(s1[left] ^ s1[left + step]) + np.bitwise_count(s2[left] ^ s2[left + step])
                pair = left[apart <= most]
                near[pair] = near[pair + step] = True
                step += 1
            yield pa.RecordBatch.from_arrays([pa.array(rows.column("bucket").to_numpy()[near]), pa.array(node[near])], ["bucket", "node"])

    candidates = in_blocks(spark, bucketed.select("node", "s1", "s2", "bucket")).drop("block", "blocks")
    flagged = staged(spark, candidates.mapInArrow(near_codes, "bucket long, node long").distinct())
    full = flagged.join(classes.select("node", "copies", "embedding"), "node").join(coded.select("node", "codes"), "node")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact cosines in each cell. A pair counts in the first table in which it agrees, and
        there in the cell of its two blocks."""
        for rows in _groups(batches):
            key = _key(rows)
            bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            node, bucket = rows.column("node").to_numpy(), rows.column("bucket").to_numpy()
            block, copies = rows.column("block").to_numpy(), rows.column("copies").to_numpy()
            codes = rows.column("codes").combine_chunks().flatten().to_numpy().reshape(-1, tables)
            units = _unit(rows.column("embedding").combine_chunks(), dimension)
            blocks = rows.column("blocks").to_numpy()
            cell = rows.column("cell").to_numpy()
            links, roots = np.zeros(len(key), dtype=np.int64), node.copy()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = slice(a, b)
                linked = units[own] @ units[own].T >= least
                np.fill_diagonal(linked, False)
                one, other = divmod(int(cell[a]), int(blocks[a]))
                if one != other:
                    linked &= block[own][:, None] != block[own][None, :]
                if not linked.any():
                    continue
                table = int(bucket[a] >> bits)
                earlier = np.zeros_like(linked)
                for t in range(table):
                    earlier |= codes[own, t][:, None] == codes[own, t][None, :]
                links[own] = (linked & ~earlier) @ copies[own]
                roots[own] = lowest_reached(linked, node[own])
            some = (links > 0) | (roots != node)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (node, links, roots)], ["node", "links", "root"])

    cells = in_blocks(spark, full.select("node", "bucket", "copies", "embedding", "codes"))
    return cells.mapInArrow(rerank, "node long, links long, root long")


def _most_different(bits: int, cosine: float) -> int:
    """Bits in which a pair at the cosine differs at most, six standard deviations above the mean."""
    chance = math.acos(cosine) / math.pi
    return math.ceil(bits * chance + 6 * math.sqrt(bits * chance * (1 - chance)))
