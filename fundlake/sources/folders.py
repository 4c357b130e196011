"""Folders of a table on whatever file system holds it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def values(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of partition column ``name`` right below ``path``; none if there is no such folder."""
    system, folder = _located(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}="))


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _located(spark, path)
    system.delete(folder, True)
