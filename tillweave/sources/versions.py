"""Versioned folders: a version counts once its marker is written, so a save that stops midway leaves the last one in place."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_DONE = "_done"


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the finished versions, oldest first."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return []
    found = []
    for status in fs.listStatus(at):
        inner = status.getPath().toString()
        marker, _ = _fs(spark, f"{inner}/{_DONE}")
        if status.isDirectory() and fs.exists(marker):
            found.append((status.getPath().getName(), inner))
    return [inner for _, inner in sorted(found)]


def new_version(spark: SparkSession, path: str) -> str:
    """A folder name for a version after all finished ones; two writers never share one."""
    last = versions(spark, path)
    number = 1 + int(last[-1].rsplit("/", 1)[-1].split("-")[0]) if last else 1
    return f"{path.rstrip('/')}/{number:010d}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, version: str) -> None:
    """From now on this version is read: creating the marker is one step of the file system."""
    at, fs = _fs(spark, f"{version}/{_DONE}")
    fs.create(at, False).close()


def current(spark: SparkSession, path: str) -> str:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished version in {path}")
    return found[-1]


def prune(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete finished versions but the last ``keep``; returns how many went. Their markers go first."""
    old = versions(spark, path)[:-keep] if keep > 0 else versions(spark, path)
    for version in old:
        marker, fs = _fs(spark, f"{version}/{_DONE}")
        fs.delete(marker, False)
        at, fs = _fs(spark, version)
        fs.delete(at, True)
    return len(old)
