"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "faultline") -> SparkSession:
    """A session for tests and local runs; on a cluster the submitter builds its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Looking up the calling line for every column operation takes longer than planning a small query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone, so every conversion to and from an instant is done in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return os.path.join(tempfile.gettempdir(), f"faultline-{spark.sparkContext.applicationId}")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so a rerun cannot read a half-written one."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
