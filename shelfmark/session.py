"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "shelfmark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs are tested with.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the launcher names the master, shuffles
    start with many partitions, and adaptive execution merges them to partitions of a size that fits.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        merging = "spark.sql.adaptive.coalescePartitions"
        builder = (
            builder.config(f"{merging}.initialPartitionNum", "10000")
            .config(f"{merging}.parallelismFirst", "false")
            .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    ``spark.checkpoint.dir`` names it. Only a session whose driver and executors are one process may go
    without: it gets a folder of its own once, which is then set as the session's checkpoint folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A folder below the work folder that no other run uses."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
