"""Numbered folders of a file system that all executors share."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, folder: str, named: str, complete: bool = False) -> list[int]:
    """Numbers of the entries of ``folder`` that are called ``named`` (one group: the number), ascending;
    ``complete`` ones carry Spark's success marker. A missing folder has none."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        match = re.fullmatch(named, status.getPath().getName())
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if match and (not complete or fs.exists(done)):
            found.append(int(match.group(1)))
    return sorted(found)


def exists(spark: SparkSession, folder: str) -> bool:
    path, fs = _path(spark, folder)
    return fs.exists(path)


def remove(spark: SparkSession, folder: str) -> bool:
    """Removes a folder with all it holds; false if there is none."""
    path, fs = _path(spark, folder)
    return fs.delete(path, True)


def empty(spark: SparkSession, folder: str) -> None:
    """Removes all that a folder holds but its success marker."""
    path, fs = _path(spark, folder)
    for status in fs.listStatus(path):
        if status.getPath().getName() != "_SUCCESS":
            fs.delete(status.getPath(), True)
