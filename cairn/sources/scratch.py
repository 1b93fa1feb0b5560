"""Paths for tables that a job writes and reads again, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[str] = []  # the folder of a local session without a setting
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a new local one only where none is set and Spark is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="cairn-"))
        at = _local[0]
    return at.rstrip("/")


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in any store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for what a query writes and reads: deleted when the application ends, or by clear_scratch."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = filesystem(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    _made.append(path)
    return f"{path}/data"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what scratch has given out; results that read it must have been written before."""
    while _made:
        fs, at = filesystem(spark, _made.pop())
        fs.delete(at, True)
