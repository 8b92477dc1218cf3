"""Reading a published mart: the sequence of commits tells which run is current."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.model import Star
from orderloom.schemas import STAR_SCHEMAS

# One small file per published run, named by its number and holding its id.
COMMITS = "commits"
RUN_LOG = "run_log"
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)


class MartNotBuilt(Exception):
    """No run has been published under the given folder."""


def run_folder(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run={run_id}"


def table_path(root: str, run_id: str, name: str) -> str:
    return f"{run_folder(root, run_id)}/{name}"


def unbuilt(root: str) -> MartNotBuilt:
    return MartNotBuilt(f"no published mart under {root}: run the pipeline first")


def commit_path(root: str, sequence: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{sequence:012d}"


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """(sequence, run_id) of every published run; numbers rise in the order of publication."""
    try:
        files = spark.read.schema("run_id string").text(
            f"{root.rstrip('/')}/{COMMITS}", wholetext=True
        )
    except AnalysisException as missing:
        raise unbuilt(root) from missing
    # A number that was claimed by a driver that died has an empty file.
    return files.select(
        F.col("_metadata.file_name").cast("bigint").alias("sequence"), "run_id"
    ).where("run_id <> ''")


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per run and table that was published, with its row count and sequence."""
    try:
        log = spark.read.schema(RUN_LOG_SCHEMA).parquet(f"{root.rstrip('/')}/{RUN_LOG}")
    except AnalysisException as missing:
        raise unbuilt(root) from missing
    return log.join(read_commits(spark, root), "run_id")


def current_run(spark: SparkSession, root: str) -> str:
    """The run published last, whichever started first."""
    last = F.max_by("run_id", "sequence").alias("run_id")
    latest = read_commits(spark, root).agg(last).first()["run_id"]
    if latest is None:
        raise unbuilt(root)
    return latest


def read_run_table(spark: SparkSession, root: str, run_id: str, name: str) -> DataFrame:
    table = spark.read.parquet(table_path(root, run_id, name))
    if name in STAR_SCHEMAS:
        return table.select(*[c for c in STAR_SCHEMAS[name].names if c in table.columns])
    return table


def read_star(spark: SparkSession, root: str, run_id: str | None = None) -> Star:
    """The five tables of a run, the current one unless another is named."""
    run = run_id or current_run(spark, root)
    return Star(**{name: read_run_table(spark, root, run, name) for name in STAR_SCHEMAS})


def read_issues(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    return read_run_table(spark, root, run_id or current_run(spark, root), "dq_issues")


def read_metrics(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    run = run_id or current_run(spark, root)
    return read_run_table(spark, root, run, "dq_metrics").select("metric", "violations")


def read_report(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    return read_run_table(spark, root, run_id or current_run(spark, root), "dq_report")
