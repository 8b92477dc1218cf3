"""The whole run: stage, find issues, build the star, gate, check, publish.

Every step ends in a table under the run's own folder, so a lost executor costs a
few tasks and a failed run costs nothing: readers follow the run log, which gains
the new run only after all gates have passed.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom import files
from orderloom.model import Staged, Star
from orderloom.plans.checks import (
    CHECKS,
    FILLED_CHECKS,
    copies_metrics,
    counted_metrics,
    gates_of,
    link_metrics,
    listed_metrics,
    other_metrics,
    report_of,
    row_counts,
)
from orderloom.plans.issues import find_issues
from orderloom.plans.lease import LEASE_SECONDS, Lease, reclaimable
from orderloom.plans.star import (
    build_category,
    build_customer,
    build_date,
    build_product,
    conform,
    fact_of,
    first_orders,
    with_amount,
)
from orderloom.schemas import DEFAULT_RULES, DIMENSIONS, STAR_SCHEMAS, Rules
from orderloom.sources.mart import (
    COMMITS,
    RUN_LOG,
    commit_path,
    read_commits,
    read_issues,
    read_metrics,
    read_report,
    read_star,
    run_folder,
    table_path,
    unbuilt,
)

# File in the folder of a run that is over, published or not: the last commit by then.
ENDED = "_ended"

# Tables are written in this codec: a run holds its staged sources beside its star.
CODEC = "zstd"

# Orders that are shuffled at once to find the first row of each; more of them go slice by slice.
ORDERS_AT_ONCE = 50_000_000
FIRST_ORDERS = "staged/first_orders"

# Whether a query deletes its shuffle files as it ends; Spark before 4.1 does not know it.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class PublishBlocked(Exception):
    """A gate or a required check failed; the mart still shows the previous run."""


@dataclass(frozen=True)
class RunResult:
    """What a run published, and how many rows it read and wrote."""

    run_id: str
    root: str
    sequence: int
    source_rows: dict[str, int]
    table_rows: dict[str, int]

    def star(self, spark: SparkSession) -> Star:
        return read_star(spark, self.root, self.run_id)

    def issues(self, spark: SparkSession) -> DataFrame:
        return read_issues(spark, self.root, self.run_id)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return read_metrics(spark, self.root, self.run_id)

    def report(self, spark: SparkSession) -> DataFrame:
        return read_report(spark, self.root, self.run_id)


def new_run_id() -> str:
    """Unique, and sorting by start time."""
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def write_observed(
    rows: DataFrame, path: str, metrics: Iterable[Column] = (), partition_by: str | None = None
) -> dict[str, int]:
    """Write a table and return its `rows` and further counts, observed during the write itself."""
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path, compression=CODEC)
    return seen.get


def claim_commit(spark: SparkSession, root: str, run_id: str) -> int:
    """Publish a run under the next free number, which only one run can get."""
    taken = [int(name) for name in files.names(spark, f"{root.rstrip('/')}/{COMMITS}")]
    sequence = max(taken, default=0) + 1
    while not files.create_text(spark, commit_path(root, sequence), run_id):
        sequence += 1
    return sequence


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Let every query delete its shuffle files as it ends, and leave the session as it was.

    Each step of a run is written and read again, so no query wants them twice. Otherwise they stay
    until the driver happens to collect the plans that they belong to.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


class _Run:
    """The tables of one run while it is being built."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: Rules,
        lease_seconds: float,
        keep_staged: bool = False,
    ):
        self.spark = spark
        self.root = root
        self.rules = rules
        self.keep_staged = keep_staged
        self.run_id = new_run_id()
        self.lease = Lease(spark, run_folder(root, self.run_id), lease_seconds)
        self.source_rows: dict[str, int] = {}
        self.table_rows: dict[str, int] = {}
        self.observed: dict[str, dict[str, int]] = {}

    def path(self, name: str) -> str:
        return table_path(self.root, self.run_id, name)

    def stage(self, staged: Staged) -> Staged:
        """Write the sources once as columnar tables; all later steps read those."""
        for name, rows in staged.items():
            self.source_rows[name] = write_observed(rows, self.path(f"staged/{name}"))["rows"]
        return Staged(
            **{
                name: self.spark.read.schema(rows.schema).parquet(self.path(f"staged/{name}"))
                for name, rows in staged.items()
            }
        )

    def stage_first_orders(self, orders: DataFrame) -> DataFrame:
        """`first_orders`; of many, slice by slice, so that no shuffle holds them all."""
        slices = -(-self.source_rows["orders"] // ORDERS_AT_ONCE)
        if slices <= 1:
            return first_orders(orders)
        place = F.pmod(F.xxhash64("order_id"), F.lit(slices))
        path = self.path(FIRST_ORDERS)
        for i in range(slices):
            first = first_orders(orders.where(place == i))
            first.write.mode("append").parquet(path, compression=CODEC)
        if not self.keep_staged:
            files.delete(self.spark, self.path("staged/orders"))
        return self.spark.read.schema(first.schema).parquet(path)

    def write_issues(self, issues: DataFrame) -> DataFrame:
        stamped = issues.select(
            F.lit(self.run_id).alias("run_id"), F.current_timestamp().alias("logged_at"), "*"
        )
        return self.write(stamped, "dq_issues")

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(self.path(name), compression=CODEC)
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def write_table(self, name: str, rows: DataFrame) -> DataFrame:
        self._observe(name, conform(rows, name))
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(self.path(name))

    def write_fact_by_year(self, rows: DataFrame) -> None:
        """Partition the fact by year; the rebalance keeps files large and even."""
        yearly = conform(rows, "FactOrder").withColumn("order_year", F.year("OrderDate"))
        self._observe("FactOrder", yearly.hint("rebalance", "order_year"), "order_year")

    def _observe(self, name: str, rows: DataFrame, partition_by: str | None = None) -> None:
        """Write a table; its row conditions are counted on the way, so no check reads it for them."""
        seen = write_observed(rows, self.path(name), row_counts(name, self.rules), partition_by)
        self.table_rows[name] = seen["rows"]
        self.observed[name] = counted_metrics(name, seen)

    def row_metrics(self, names: Iterable[str]) -> DataFrame:
        return listed_metrics(
            self.spark, {m: n for name in names for m, n in self.observed[name].items()}
        )

    def write_metrics(self, metrics: list[DataFrame], part: str) -> DataFrame:
        """Metrics are one row each; the parts together are the run's metrics table."""
        merged = reduce(DataFrame.unionByName, metrics)
        return self.write(merged.coalesce(1), f"dq_metrics/part={part}")

    def require_gates(self, metrics: DataFrame, names: Iterable[str]) -> None:
        """Raise if a table breaks its keys or lacks a required name."""
        self.require_none(gates_of(metrics, names).where("violations > 0"), "metric")

    def require_checks(self, report: DataFrame, checks: Iterable[str]) -> None:
        wanted = F.col("check").isin(list(checks))
        named = F.concat_ws(" ", "check", "name").alias("label")
        self.require_none(
            report.where(wanted & ~F.col("passed")).select(named, "violations"), "label"
        )

    def require_none(self, broken: DataFrame, label: str) -> None:
        found = ", ".join(f"{row[label]}: {row['violations']}" for row in broken.collect())
        if found:
            raise PublishBlocked(f"run {self.run_id} not published ({found})")

    def end(self) -> None:
        """Mark the run as over, at the place in the sequence that was reached by then."""
        taken = files.names(self.spark, f"{self.root.rstrip('/')}/{COMMITS}")
        files.write_text(self.spark, self.path(ENDED), str(int(taken[-1]) if taken else 0))
        self.lease.release()

    def publish(self) -> RunResult:
        """Log the run's row counts, then commit it; from then on readers see it."""
        entries = [
            F.struct(F.lit(kind), F.lit(name), F.lit(rows).cast("bigint"))
            for kind, counts in (("source", self.source_rows), ("table", self.table_rows))
            for name, rows in counts.items()
        ]
        listed = self.spark.range(1).select(
            F.inline(F.array(*entries)).alias("kind", "table_name", "row_count")
        )
        listed.select(
            F.lit(self.run_id).alias("run_id"),
            "*",
            F.current_timestamp().alias("published_at"),
        ).write.mode("append").parquet(f"{self.root.rstrip('/')}/{RUN_LOG}")
        if not self.lease.held():
            raise PublishBlocked(f"run {self.run_id} not published (its lease has lapsed)")
        sequence = claim_commit(self.spark, self.root, self.run_id)
        return RunResult(self.run_id, self.root, sequence, self.source_rows, self.table_rows)


def run_pipeline(
    spark: SparkSession,
    staged: Staged,
    root: str,
    rules: Rules = DEFAULT_RULES,
    fail_on: Iterable[str] = (),
    fact_by_year: bool = False,
    keep_staged: bool = False,
    allow_empty: bool = False,
    lease_seconds: float = LEASE_SECONDS,
) -> RunResult:
    """Build and publish a full new version of the mart under `root`.

    `fail_on` names checks that must pass; the gates always must, and so must the
    checks that no table is empty, unless `allow_empty` says otherwise. `fact_by_year`
    partitions the fact for date filters at the price of one more shuffle of it. A driver
    that dies leaves a folder that `expire_runs` reclaims once its lease has lapsed.
    """
    required = [*fail_on, *(() if allow_empty else FILLED_CHECKS)]
    unknown = set(required) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks {sorted(unknown)}")
    run = _Run(spark, root, rules, lease_seconds, keep_staged)
    try:
        with shuffles_let_go(spark):
            build_tables(run, run.stage(staged), required, fact_by_year)
        return run.publish()
    finally:
        if not keep_staged:
            files.delete(spark, run.path("staged"))
        run.end()


def build_tables(run: _Run, source: Staged, required: list[str], fact_by_year: bool) -> None:
    """Write every table of a run, dimensions before the fact, and insist on the gates."""
    issues = run.write_issues(find_issues(source, run.rules))
    category = run.write_table("DimCategory", build_category(source.products))
    dimensions = Star(
        DimCategory=category,
        DimCustomer=run.write_table("DimCustomer", build_customer(source.customers)),
        DimProduct=run.write_table("DimProduct", build_product(source.products, category)),
        DimDate=run.write_table("DimDate", build_date(source.orders)),
    )
    metrics = run.write_metrics(
        [run.row_metrics(DIMENSIONS), *(copies_metrics(dimensions, name) for name in DIMENSIONS)],
        "dimensions",
    )
    run.require_gates(metrics, DIMENSIONS)
    orders = run.stage_first_orders(source.orders)
    fact = fact_of(with_amount(orders, dimensions.DimProduct, run.table_rows["DimProduct"]))
    if fact_by_year:
        run.write_fact_by_year(fact)
    else:
        run.write_table("FactOrder", fact)
    files.delete(run.spark, run.path(FIRST_ORDERS))
    star = read_star(run.spark, run.root, run.run_id)
    fact_metrics = run.write_metrics(
        [
            run.row_metrics(["FactOrder"]),
            copies_metrics(star, "FactOrder"),
            link_metrics(star),
            other_metrics(run.spark, star, issues),
        ],
        "fact",
    )
    run.require_gates(fact_metrics, ["FactOrder"])
    report = run.write(report_of(metrics.unionByName(fact_metrics)).coalesce(1), "dq_report")
    run.require_checks(report, required)


def expire_runs(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete what the last `keep` published runs have replaced; return the runs' ids.

    Gone are ended runs that were published, or given up, before the oldest run that is kept
    was published, and runs that have not ended but whose lease lapsed long ago. A run that
    holds its lease stays, and so does a folder without lease or mark.
    """
    if keep < 1:
        raise ValueError("the current run must stay")
    sequence = {row["run_id"]: row["sequence"] for row in read_commits(spark, root).collect()}
    kept = sorted(sequence, key=sequence.get)[-keep:]
    if not kept:
        raise unbuilt(root)
    oldest = sequence[kept[0]]
    old: list[tuple[int, str]] = []
    for run in (n.removeprefix("run=") for n in files.names(spark, root) if n.startswith("run=")):
        folder = run_folder(root, run)
        if run in kept:
            continue
        if files.exists(spark, f"{folder}/{ENDED}"):
            at = sequence.get(run, int(files.read_text(spark, f"{folder}/{ENDED}")))
            if at < oldest:
                old.append((at, run))
        elif reclaimable(spark, folder):
            old.append((oldest, run))
    for _, run in sorted(old):
        files.delete(spark, run_folder(root, run))
    return [run for _, run in sorted(old)]
