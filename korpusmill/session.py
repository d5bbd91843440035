"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, app: str = "korpusmill") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="korpusmill-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Tables written there outlive any executor. Only a single-machine session
    may fall back to a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: computed once, and safe from executor loss."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
