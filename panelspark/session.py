"""Session settings for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "panelspark", cores: int | str = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("PANELSPARK_SHUFFLE", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        # small local data: keep all cores busy instead of merging partitions up to 1 MB
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PANELSPARK_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's spark.checkpoint.dir.

    Only a local session that names none (tests on one machine) gets a temporary
    folder, remembered in the session; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("panelspark.local.scratch", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="panelspark-")
        spark.conf.set("panelspark.local.scratch", base)
    return f"{base.rstrip('/')}/panelspark-{spark.sparkContext.applicationId}"
