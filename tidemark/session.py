"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def cluster_settings(total_cores: int) -> dict[str, str]:
    """SQL settings for a large cluster; none of them changes a result.

    Shuffles start with several partitions per core and adaptive execution merges small ones
    and splits skewed ones.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(total_cores * 8),
        "spark.sql.shuffle.partitions": str(total_cores * 3),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "tidemark") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so never overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
