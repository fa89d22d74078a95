"""Paths on whatever file system Spark reaches (Hadoop FileSystem API)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other fault (no access, no connection) is raised, never read as "absent"."""
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority."""
    fs, hpath = _fs(spark, path)
    return fs.makeQualified(hpath).toString()


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is no such folder."""
    fs, hpath = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place by one rename."""
    fs, target = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()
    if not fs.rename(part, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.delete(hpath, True)
