"""Path checks through Hadoop's file system interface, so that any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _located(spark, path)
    return system.exists(location)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table or checkpoint folder; False when there is none."""
    system, location = _located(spark, path)
    return system.exists(location) and system.delete(location, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none when it does not exist."""
    system, location = _located(spark, path)
    if not system.exists(location):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(location))


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a complete folder to a place where nothing is yet."""
    system, location = _located(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(goal.getParent())
    if not system.rename(location, goal):
        raise OSError(f"cannot move {path} to {target}")
