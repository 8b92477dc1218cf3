"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.session import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per session.

    Texts are long, so Arrow batches of them are kept short unless the session says otherwise.
    """
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch) == "10000":
        spark.conf.set(batch, "1000")
    name = "orderloom-package.zip"
    context = spark.sparkContext
    if any(path.endswith(name) for path in context._python_includes):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), name)
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    bundle.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)


def staged(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows written once to the cluster's shared folder and read back.

    Cuts the lineage: what reads the result never repeats the work before it,
    and the loss of an executor costs tasks of the current step only.
    """
    path = scratch_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def scratch_uri(spark: SparkSession) -> str:
    """A new folder in the cluster's shared folder, as a URI that Python in tasks can open."""
    path = scratch_folder(spark)
    return path if ":" in path.split("/")[0] else f"file://{path}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Words are runs of anything but blank, tab, line feed, VT, FF and CR; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of a staged table with a gapless number from 0 inside each key, in order of `place`.

    `place` is monotonically_increasing_id() as the table was written: its high bits name
    the split. Rows are numbered inside their split, and counts per split give the
    offsets, so a key that holds most rows is numbered in as many pieces as splits.
    """
    split = rows.withColumn("split", F.shiftrightunsigned("place", 33))
    before = Window.partitionBy(key).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy(key, "split")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(key, "split", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    inside = F.row_number().over(Window.partitionBy(key, "split").orderBy("place")) - 1
    return (
        split.withColumn("inside", inside)
        .join(offsets, [key, "split"])
        .withColumn(name, F.col("inside") + F.col("offset"))
        .drop("inside", "offset", "split")
    )


def connected(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node in links (a, b); root is the smallest reachable node.

    Each round hangs every node on the smallest root among its neighbours' roots and
    then replaces roots by their own roots, so that long chains shrink by doubling. A
    node with very many links costs one row per map task in the minimum.
    Every round is written to the shared folder. Links must not hold nulls.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(spark, both.where("a <> b").distinct())
    roots = staged(
        spark,
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root")
        ),
    )
    while True:
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        apart = edges.join(of_b, "b").join(of_a, "a").where("root_a <> root_b")
        hung = staged(
            spark,
            apart.select(F.greatest("root_a", "root_b").alias("node"), F.least("root_a", "root_b").alias("to"))
            .groupBy("node")
            .agg(F.min("to").alias("to")),
        )
        if hung.isEmpty():
            return roots
        # A root's new root may itself have been hung elsewhere: follow until settled.
        hung = _settled(spark, hung)
        moved = roots.join(hung.select(F.col("node").alias("root"), "to"), "root", "left")
        roots = staged(spark, moved.select("node", F.coalesce("to", "root").alias("root")))


def _settled(spark: SparkSession, parents: DataFrame) -> DataFrame:
    """Rows (node, to) with every `to` replaced by the end of its chain, by pointer doubling."""
    while True:
        nexts = parents.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        doubled = staged(spark, parents.join(nexts, "to", "left").select("node", "to", "beyond"))
        if doubled.where("beyond IS NOT NULL").isEmpty():
            return doubled.select("node", "to")
        parents = doubled.select("node", F.coalesce("beyond", "to").alias("to"))


def contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) that connect what links (hub, node) connect, about one per node.

    A node keeps the link to its smallest hub, and each of its other hubs is linked with that
    one. Where hubs recur, as the smallest of a group does, few distinct links are left of the
    many that groups of the same nodes make. The links should be staged, as they are read twice,
    and a node must not have more of them than one task holds.
    """
    least = F.min("hub").alias("least")
    own = links.groupBy("node").agg(least).select(F.col("least").alias("a"), F.col("node").alias("b"))
    beside = links.withColumn("least", F.min("hub").over(Window.partitionBy("node")))
    others = beside.where("hub <> least").select(F.col("least").alias("a"), F.col("hub").alias("b"))
    return own.unionByName(others).where("a <> b").distinct()


#: Up to so many 64-bit keys (16 MB) are broadcast to pick their rows; more are joined.
BROADCAST_KEYS = 2_000_000


def picked(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the distinct keys of a staged table, or is not ("left_anti")."""
    few = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, key, how)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows with equal keys, out of batches sorted by the key."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        values = rest.column(key).to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if len(cuts):
            yield rest.slice(0, int(cuts[-1])).combine_chunks()
            rest = rest.slice(int(cuts[-1]))
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def lowest_reached(linked: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The smallest label that each row of a symmetric matrix of links reaches."""
    while True:
        reached = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, reached)
        if (new == label).all():
            return label
        label = new
