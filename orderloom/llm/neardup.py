"""Near-duplicate documents by a chosen-path set similarity join.

Every tree of the join starts at a minwise value of each document; a node then chooses a few
other minwise values, by a hash of the node, and sends each of its documents to one child per
choice, named by the document's value. Alike documents make alike choices. Small nodes are
compared exhaustively, large ones branch on. Independent trees are repeated until a pair at the
threshold meets with the target recall at the depth reached: documents of nodes that have to
branch deeper get more trees.

Nodes of many near copies never fall apart by branching. So each node first compares all its
documents with one of them, confirmed links join into components, and from then on only pairs
of different components matter: a node that is one component is done.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.bytehash import mixed
from orderloom.llm.common import connected, contracted, lowest_reached, picked, ship, staged, whole_groups
from orderloom.llm.shingles import MINS, minwise, set_key, shingle_sets, sketches
from orderloom.llm.tokens import chunks, forget

#: Chance that a pair just similar enough meets in some tree; gives the number of trees.
RECALL = 0.9999
#: A node up to this size is small: its pairs are compared.
SMALL = 256
#: Nodes that are still large at this depth are compared in pairs of blocks, however many.
DEEPEST = 9
#: Documents of a block: no cell of a large node has more than two blocks.
BLOCK = 512
#: Chains of near documents up to so many blocks are compared in pairs of blocks: then a set is
#: shipped once per block. In longer chains, once per group of the trees, which is about 60 times.
MOST_BLOCKS = 16
#: A large node is done at once if its documents outside its largest component make at most so
#: many pairs with all of its documents.
AT_ONCE = 4_000_000


def _most_children(similarity: float) -> np.ndarray:
    """Cumulative chances of a node's number of children: Poisson with mean 1 / similarity."""
    mean = 1 / similarity
    chances = [math.exp(-mean) * mean**i / math.factorial(i) for i in range(9)]
    return np.cumsum(chances)


def trees_for(depth: int, similarity: float) -> int:
    """Trees in which a pair of this similarity meets, `depth` choices deep, with a chance of RECALL;
    MINS at most, since every tree starts at another minwise value.

    Given its share of equal minwise values, which is binomial, a pair meets at a root with that
    chance; the children that a node sends both to are Poisson, with mean share / similarity.
    """
    equal = np.arange(MINS + 1)
    ways = np.array([float(math.comb(MINS, i)) for i in range(MINS + 1)])
    weight = ways * similarity**equal * (1 - similarity) ** (MINS - equal)
    share = equal / MINS
    together = np.ones(MINS + 1)
    for _ in range(depth - 1):
        together = 1 - np.exp(-share / similarity * together)
    missed = 1 - share * together
    return next((n for n in range(1, MINS) if (weight * missed**n).sum() <= 1 - RECALL), MINS)


def _children(nodes: np.ndarray, owner: np.ndarray, mins: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(owner, child node) for each child that a node sends its document, a row of `mins`, to."""
    chance = (mixed(nodes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64) / 2**53
    count = np.searchsorted(_most_children(similarity), chance)
    row = np.repeat(np.arange(len(nodes)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    chosen = mixed(nodes[row] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    coordinate = (chosen >> np.uint64(40)).astype(np.int64) % MINS
    value = mins[owner[row], coordinate].astype(np.uint64)
    return owner[row], mixed(chosen + value * np.uint64(0xC2B2AE3D27D4EB4F))


def _roots(mins: np.ndarray, trees: range) -> tuple[np.ndarray, np.ndarray]:
    """(owner, node) of each tree's first choice: tree t takes minwise value t."""
    tree = np.array(trees, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    nodes = mixed(mins[:, trees.start : trees.stop].astype(np.uint64) + (tree << np.uint64(1)))
    return np.repeat(np.arange(len(mins)), len(trees)), nodes.ravel()


def _mins_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, MINS)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """Each document as `row` with size, key and minwise values of its set."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            sizes, ones, twos, mins = [], [], [], []
            for texts in chunks(batch.column(1)):
                for hashes in shingle_sets(texts, width):
                    one, two = set_key(hashes)
                    sizes.append(len(hashes))
                    ones.append(one)
                    twos.append(two)
                    mins.append(minwise(hashes).tobytes() if len(hashes) else None)
            columns = [pa.array(x, pa.int64()) for x in (sizes, ones, twos)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(mins, pa.binary())], ["row", "n_shingles", "set_a", "set_b", "mins"]
            )

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_shingles long, set_a long, set_b long, mins binary"
    return rows.mapInArrow(build, schema).withColumn("place", F.monotonically_increasing_id())


class _Join:
    """The state of one join: texts and minwise values by place, tested pairs, links, roots."""

    def __init__(self, spark: SparkSession, sets: DataFrame, firsts: DataFrame, width: int, percent: int):
        self._spark, self._sets, self._firsts = spark, sets, firsts
        self._width, self._percent = width, percent
        self._similarity = percent / 100
        chance = (1 - self._similarity) / 2
        self._most = math.ceil(MINS * chance + 4.5 * math.sqrt(MINS * chance * (1 - chance)))
        self.roots: DataFrame | None = None

    def _walk(self, source: DataFrame, steps: int, trees: range = range(0)) -> DataFrame:
        """Rows (node, place, s1, s2), so many choices below the nodes of rows (place, mins, node),
        or below the roots of `trees` for rows (place, mins)."""
        similarity = self._similarity

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 2000):
                    part = batch.slice(begin, 2000)
                    mins, place = _mins_of(part.column(1)), part.column(0).to_numpy()
                    if part.num_columns > 2:
                        owner, nodes = np.arange(len(mins)), part.column(2).to_numpy().view(np.uint64)
                    else:
                        owner, nodes = _roots(mins, trees)
                    for _ in range(steps):
                        owner, nodes = _children(nodes, owner, mins, similarity)
                    sketch = sketches(mins)[owner]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (nodes.view(np.int64), place[owner], sketch[:, 0].copy(), sketch[:, 1].copy())],
                        ["node", "place", "s1", "s2"],
                    )

        return source.mapInArrow(walk, "node long, place long, s1 long, s2 long")

    def _deeper(self, rows: DataFrame, depth: int, trees: range) -> DataFrame:
        """The children at `depth` of nodes that branch, rows (node, place), and the nodes at this
        depth of more trees for their documents. A pair that any tree brought together so far, but
        in no node that was done, has both its documents there."""
        own = rows.select("node", "place")
        keys = staged(self._spark, own.select("place").distinct())
        # Few documents are in large nodes; the minwise values of the others stay where they are.
        source = staged(self._spark, picked(self._firsts.select("place", "mins"), keys, "place"))
        below = source.join(own.hint("merge"), "place").select("place", "mins", "node")
        return self._walk(below, 1).unionByName(self._walk(source, depth - 1, trees))

    def _with_component(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("part", F.col("place"))
        roots = self.roots.select(F.col("node").alias("place"), F.col("root").alias("part"))
        return rows.join(roots.hint("merge"), "place", "left").withColumn("part", F.coalesce("part", "place"))

    def _shared(self, rows: DataFrame) -> DataFrame:
        """Rows of nodes with more than one document. Most nodes have one; only a count of each is shuffled."""
        nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
        return staged(self._spark, picked(rows, staged(self._spark, nodes), "node"))

    def _undone(self, rows: DataFrame, least: int) -> DataFrame:
        """Rows of nodes with `least` documents or more in more than one component, with the
        node's size and its first document."""
        parted = self._with_component(rows)
        nodes = staged(
            self._spark,
            parted.groupBy("node")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("part").alias("lowest"),
                F.max("part").alias("highest"),
                F.min("place").alias("pivot"),
                F.min_by("part", "place").alias("pivot_part"),
                F.min_by("s1", "place").alias("p1"),
                F.min_by("s2", "place").alias("p2"),
            )
            .where((F.col("n") >= least) & (F.col("lowest") < F.col("highest")))
            .drop("lowest", "highest"),
        )
        # Sides that grow with the documents are merged at every size, as they are on a cluster.
        return staged(self._spark, parted.join(nodes.hint("merge"), "node"))

    def _texts(self, keys: DataFrame) -> DataFrame:
        return picked(self._sets.select("place", F.col("row.text").cast("string").alias("text")), keys, "place")

    def _join(self, links: DataFrame) -> None:
        """Join components by staged links; the roots so far stand for the links so far."""
        if links.isEmpty():
            return
        if self.roots is not None:
            links = links.unionByName(self.roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        self.roots = connected(self._spark, links)

    def _confirm(self, pairs: DataFrame) -> None:
        """Test pairs (a, b) on their full sets and join what is linked."""
        spark, width, percent = self._spark, self._width, self._percent
        pairs = staged(spark, pairs.distinct())
        if pairs.isEmpty():
            return
        keys = staged(spark, pairs.select(F.explode(F.array("a", "b")).alias("place")).distinct())
        texts = staged(spark, self._texts(keys))
        one = texts.select(F.col("place").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("place").alias("b"), F.col("text").alias("text_b"))

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                linked = []
                for begin in range(0, batch.num_rows, 64):
                    left, right = (shingle_sets(batch.column(i).slice(begin, 64).to_pylist(), width) for i in (2, 3))
                    for x, y in zip(left, right, strict=True):
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        linked.append(100 * both >= percent * (len(x) + len(y) - both))
                keep = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(2)], ["a", "b"])

        # Texts are not broadcast, however few: the driver never holds them, and plans are alike at every size.
        full = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "text_a", "text_b")
        self._join(staged(spark, full.mapInArrow(test, "a long, b long")))

    def _near(self, rows: DataFrame) -> DataFrame:
        """Rows (cell, low, place) that are near, in their sketches, to a row of their group of
        another component. `cell` now names the documents of a group that chains of such nearness
        hold together, by a hash of them, so what many trees bring together occurs once; `low` is
        the smallest of them, which many groups share."""
        most = self._most

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in whole_groups(batches, "cell"):
                yield _near_rows(table, most)

        keyed = rows.select(F.xxhash64("node", "cell").alias("cell"), "place", "part", "s1", "s2", "query", "block")
        return keyed.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "cell long, low long, place long").distinct()

    def _confirm_cells(self, rows: DataFrame) -> None:
        """Compare the documents of each group that are near others of another component, on
        their full sets, and join what is linked. Only links leave the tasks.

        Documents that chains of nearness hold together in any groups are compared in pairs of
        blocks of the chain; in chains of more than MOST_BLOCKS, group by group."""
        spark, width, percent = self._spark, self._width, self._percent
        near = staged(spark, self._near(rows))
        if near.isEmpty():
            return
        chains = connected(spark, contracted(near.select(F.col("low").alias("hub"), F.col("place").alias("node"))))
        blocks = chains.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        chained = staged(spark, chains.withColumnRenamed("node", "place").join(blocks, "root"))
        short = _chain_cells(chained.where(F.col("blocks") <= MOST_BLOCKS))
        long = chained.where(F.col("blocks") > MOST_BLOCKS).select("place")
        near = staged(spark, short.unionByName(near.select("cell", "place").join(long, "place", "left_semi").distinct()))
        keys = staged(spark, near.select("place").distinct())

        def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [x.tobytes() for texts in chunks(batch.column(1)) for x in shingle_sets(texts, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["place", "members"])

        sets = staged(spark, self._texts(keys).mapInArrow(hashes, "place long, members binary"))

        def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in whole_groups(batches, "cell"):
                cell, place, members = (table.column(name) for name in ("cell", "place", "members"))
                cell, place = cell.to_numpy(), place.to_numpy()
                bounds = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
                for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                    own = place[begin:end]
                    sets = [np.frombuffer(x, dtype=np.uint64) for x in members.slice(begin, end - begin).to_pylist()]
                    root = lowest_reached(_alike(sets, percent), own)
                    some = root != own
                    yield pa.RecordBatch.from_arrays([pa.array(root[some]), pa.array(own[some])], ["hub", "node"])

        grouped = near.join(sets.hint("merge"), "place").repartition("cell").sortWithinPartitions("cell")
        found = staged(spark, grouped.select("cell", "place", "members").mapInArrow(link, "hub long, node long").distinct())
        self._join(staged(spark, contracted(found)))

    def run(self) -> DataFrame | None:
        """Rows (node, root) by place for every document that has a link, or None."""
        depth, leaves = 2, []
        trees = trees_for(depth, self._similarity)
        level = staged(self._spark, self._walk(self._firsts.select("place", "mins"), depth - 1, range(trees)))
        columns = ["node", "place", "s1", "s2", "cell", "query", "block"]
        while True:
            starred = self._undone(self._shared(level), 2)
            if starred.isEmpty():
                break
            apart = F.bit_count(F.col("s1").bitwiseXOR(F.col("p1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("p2")))
            near = (F.col("part") != F.col("pivot_part")) & (apart <= self._most)
            self._confirm(starred.where(near).select(F.col("pivot").alias("a"), F.col("place").alias("b")))
            rows = starred.where("n > 2").select("node", "place", "s1", "s2")
            left = self._undone(rows, 3)
            small = left.where(F.col("n") <= SMALL).withColumns({"cell": F.lit(0).cast("long"), "query": F.lit(True), "block": F.col("place")})
            large = left.where(F.col("n") > SMALL)
            leaves.append(small.select(columns))
            if large.isEmpty():
                break
            large = staged(self._spark, _with_queries(large))
            done = F.lit(True) if depth >= DEEPEST else F.col("queries") * F.col("n") <= AT_ONCE
            leaves.append(_cells(large.where(done)).select(columns))
            branching = large.where(~done)
            if branching.isEmpty():
                break
            depth += 1
            before, trees = trees, max(trees, trees_for(depth, self._similarity))
            level = staged(self._spark, self._deeper(branching, depth, range(before, trees)))
        if leaves:
            # All levels at once, by the components that the stars of all levels have made.
            self._confirm_cells(self._with_component(reduce(DataFrame.unionByName, leaves)))
        return self.roots


def _with_queries(rows: DataFrame) -> DataFrame:
    """Rows with `query`, whether the document is outside its node's largest component, and
    `queries`, how many of the node are."""
    parts = rows.groupBy("node", "part").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("node").agg(F.max("size").alias("size"), F.max_by("part", "size").alias("main"))
    return rows.join(largest.hint("merge"), "node").withColumns(
        {"query": F.col("part") != F.col("main"), "queries": F.col("n") - F.col("size")}
    )


def _cells(rows: DataFrame) -> DataFrame:
    """Each row once for each cell of its node that it is in, with its `block` there.

    Queries are in blocks 0 to q - 1 of the node, the other documents in blocks from q on.
    Cell (i, j), i <= j, i < q, brings blocks i and j together, so that every query meets every
    document and no task gets more than two blocks of a large node. Rows of one `block` are
    not compared in a cell; in cell (i, i) each row is a block of its own, named by its place.
    """
    of_queries = F.ceil(F.col("queries") / BLOCK)
    blocks = of_queries + F.ceil((F.col("n") - F.col("queries")) / BLOCK)
    hashed = F.xxhash64("place")
    mine = F.when(F.col("query"), F.pmod(hashed, of_queries)).otherwise(of_queries + F.pmod(hashed, blocks - of_queries))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("query"), blocks).otherwise(of_queries) - 1)
    cell = F.struct(
        (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).alias("cell"),
        F.when(F.col("mine") == F.col("other"), F.col("place")).otherwise(F.col("mine")).alias("block"),
    )
    cut = rows.withColumns({"mine": mine, "blocks": blocks, "other": F.explode(others)})
    return cut.select(*rows.columns, cell.alias("at")).select(*rows.columns, "at.cell", "at.block")


def _chain_cells(rows: DataFrame) -> DataFrame:
    """Rows (cell, place): each document of a chain once for each block of it, so that every two
    blocks meet in a cell."""
    mine = F.pmod(F.xxhash64("place"), F.col("blocks"))
    cell = F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return rows.withColumns({"mine": mine, "other": others}).select(cell.alias("cell"), "place")


def _near_rows(rows: pa.Table, most: int) -> pa.RecordBatch:
    group, place, part = (rows.column(name).to_numpy() for name in ("cell", "place", "part"))
    # Unsigned, since bits are counted in absolute values.
    s1, s2 = (rows.column(name).to_numpy().view(np.uint64) for name in ("s1", "s2"))
    query, block = rows.column("query").to_numpy(zero_copy_only=False), rows.column("block").to_numpy()
    lefts, rights = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    left, step = np.arange(len(group)), 1
    while True:
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            break
        right = left + step
        apart = np.bitwise_count(s1[left] ^ s1[right]) + np.bitwise_count(s2[left] ^ s2[right])
        wanted = (part[left] != part[right]) & (query[left] | query[right]) & (block[left] != block[right])
        found = left[(apart <= most) & wanted]
        lefts.append(found)
        rights.append(found + step)
        step += 1
    left, right = np.concatenate(lefts), np.concatenate(rights)
    lowest = _lowest_linked(len(group), left, right)
    near = np.unique(np.concatenate([left, right]))
    names = np.zeros(len(group), dtype=np.uint64)
    np.add.at(names, lowest[near], mixed(place[near].astype(np.uint64)))
    smallest = np.full(len(group), np.iinfo(np.int64).max)
    np.minimum.at(smallest, lowest[near], place[near])
    name, low = names[lowest[near]].view(np.int64), smallest[lowest[near]]
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(low), pa.array(place[near])], ["cell", "low", "place"])


def _lowest_linked(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The lowest row that each of `count` rows reaches by pairs (left, right) of rows."""
    lowest = np.arange(count)
    while len(left):
        low = np.minimum(lowest[left], lowest[right])
        apart = lowest[left] != lowest[right]
        if not apart.any():
            break
        # The row a label names takes the lower label too, so that chains shrink by doubling.
        for rows in (left, right, lowest[left], lowest[right]):
            np.minimum.at(lowest, rows, low)
        lowest = lowest[lowest]
    return lowest


def _alike(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets share enough: exact counts by products of incidence matrices, a slice
    of the members at a time. Members of one set alone, most of them, are shared by no pair."""
    size = np.array([len(x) for x in sets])
    _, member, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    common = times[member] > 1
    member, row = (np.cumsum(times > 1) - 1)[member[common]], row[common]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(member, kind="stable")
    member, row = member[order], row[order]
    for begin in range(0, int(member[-1]) + 1 if len(member) else 0, 4096):
        a, b = np.searchsorted(member, [begin, begin + 4096])
        incidence = np.zeros((len(sets), 4096), dtype=np.float32)
        incidence[row[a:b], member[a:b] - begin] = 1
        shared += incidence @ incidence.T
    alike = 100 * shared.astype(np.int64) >= percent * (size[:, None] + size[None, :] - shared.astype(np.int64))
    np.fill_diagonal(alike, False)
    return alike


def near_groups(
    spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Rows (place, doc_id, n_shingles, component_id, keeper), each document with its group of
    near copies, and the documents as rows (place, row).

    Documents are linked if 100 * shared shingles >= percent * all shingles of both, counted on
    whole texts; a group is what links reach. `component_id` is the smallest doc_id of the group
    and `keeper` marks one row of it, the first with that doc_id. Texts without words, null ones
    too, link with nothing. Equal sets are one document in the join, however often they occur.
    Rows without doc_id belong to groups like any other and are kept only if no row of the group has one.
    An empty table gives no rows; other columns stay in `row`, a struct of all.
    """
    ship(spark)
    sets = staged(spark, _sets(docs, width))
    full = sets.where("n_shingles > 0")
    classes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("place").alias("first"))
    keys = staged(spark, classes.select(F.col("first").alias("place")))
    firsts = staged(spark, picked(full.select("place", "mins"), keys, "place"))
    roots = _Join(spark, sets, firsts, width, percent).run()
    rows = sets.select("place", "set_a", "set_b", "n_shingles", F.col("row.doc_id").alias("doc_id"))
    member = rows.join(classes.hint("merge"), ["set_a", "set_b", "n_shingles"], "left").withColumn("first", F.coalesce("first", "place"))
    if roots is not None:
        member = member.join(roots.withColumnRenamed("node", "first").hint("merge"), "first", "left")
        member = member.withColumn("root", F.coalesce("root", "first"))
    else:
        member = member.withColumn("root", F.col("first"))
    member = staged(spark, member.select("place", "doc_id", "n_shingles", "root"))
    # Plain minima, first per doc_id, so that a large group leaves each map task as few rows.
    first = member.groupBy("root", "doc_id").agg(F.min("place").alias("place"))
    best = first.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.coalesce(F.min_by("place", "doc_id"), F.min("place")).alias("best")
    )
    named = member.join(best.hint("merge"), "root").withColumn("keeper", F.col("place") == F.col("best"))
    return named.select("place", "doc_id", "n_shingles", "component_id", "keeper"), sets.select("place", "row")


def near_digest(spark: SparkSession, docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per document."""
    groups, _ = near_groups(spark, docs.select("doc_id", "text"), width, percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return groups.select("doc_id", "n_shingles", "component_id", kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies, columns as they came."""
    groups, sets = near_groups(spark, docs, width, percent)
    return sets.join(groups.where("keeper").select("place"), "place", "left_semi").select("row.*")
