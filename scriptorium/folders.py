"""Folders of any file system that Spark reaches: listing and removing what tables no longer need."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Paths of what lies directly in a folder; none if it is not there."""
    path, fs = _path(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(path)] if fs.exists(path) else []


def remove(spark: SparkSession, paths: list[str]) -> int:
    """Delete files and folders with all they hold; how many were there."""
    return sum(bool(fs.delete(path, True)) for path, fs in (_path(spark, p) for p in paths))


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Delete a path when the driver ends."""
    hadoop, fs = _path(spark, path)
    fs.deleteOnExit(hadoop)
