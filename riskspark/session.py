"""Session helpers: a tuned local session and the shared folder for written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cores: str | int = "*", app: str = "riskspark", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """Calendar features are defined in UTC, whatever zone the session came with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``, or else the warehouse folder.

    Only when driver and executors are one process does a session without that
    setting get a folder of this machine, one per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and re.match(r"local(\[|$)", spark.sparkContext.master):
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="riskspark-")
        root = _local_folders[app]
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written below the shared folder and read back: computed once, and lineage ends at files."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
