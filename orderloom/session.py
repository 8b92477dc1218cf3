"""Session and scratch folder helpers for tests, the bench and the command line."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the caller brings a configured one."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """A new path for tables that cut lineage, in the cluster's shared folder.

    The shared folder is `spark.checkpoint.dir`. Only a local session without
    that setting falls back to the machine's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="orderloom-")
    return f"{shared.rstrip('/')}/orderloom-{uuid.uuid4().hex}"
