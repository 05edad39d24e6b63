"""Folders on any file system Spark reaches: what is in them, and taking them away."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    where, system = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _place(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Takes a folder away with all it holds; nothing happens if it is gone already."""
    where, system = _place(spark, path)
    system.delete(where, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder."""
    where, system = _place(spark, path)
    return system.getContentSummary(where).getLength()
