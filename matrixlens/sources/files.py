"""Folders of any Hadoop file system, one level at a time."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _system(spark: SparkSession, folder: str) -> tuple[Any, Any]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[Any]:
    """File states of what lies directly in ``folder``, files whose names begin with a dot included; none if it is not there."""
    path, system = _system(spark, folder)
    return list(system.listStatus(path)) if system.exists(path) and system.getFileStatus(path).isDirectory() else []


def visible_files(states: list[Any]) -> list[Any]:
    """Those that are files a reader of tables looks at."""
    return [s for s in states if s.isFile() and s.getPath().getName()[0] not in "._"]


def delete(spark: SparkSession, folder: str) -> None:
    path, system = _system(spark, folder)
    system.delete(path, True)
