"""Cut lineage by writing an intermediate result to the shared checkpoint folder.

Staged folders live as long as something may read them: a load deletes its own
staging when the load is written; folders staged for queries are recorded and
deleted by ``release_staged`` — called at interpreter exit, or explicitly by a
caller that knows its results have been consumed.
"""

from __future__ import annotations

import atexit
import os
import shutil
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from curdle.session import apply_runtime_tuning, scratch_path

_STAGED: list[tuple[SparkSession, str]] = []
_LOCK = threading.Lock()


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir``; return the re-read DataFrame and its path.

    Later consumers scan the written files (with column pruning and filter
    pushdown) instead of recomputing the lineage, and a lost executor only
    costs re-reading files, not re-running upstream stages. The folder is the
    cluster's shared checkpoint location, never a machine-local one.
    """
    spark = df.sparkSession
    apply_runtime_tuning(spark)  # whoever calls: what is staged needs no shuffle files any more
    path = scratch_path(spark, f"curdle/{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for a result whose readers are not known; the folder is released later."""
    out, path = stage(df, name)
    release_later(df.sparkSession, path)
    return out


def release_later(spark: SparkSession, path: str) -> None:
    """Leave a staged folder to ``release_staged``."""
    with _LOCK:
        _STAGED.append((spark, path))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged folder once nothing reads it any more (best effort, any Hadoop file system)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
        return
    except Exception:  # noqa: BLE001 — stopped context: fall back to the local file system
        pass
    local = path[len("file:") :] if path.startswith("file:") else path
    if "://" not in local and os.path.isdir(local):
        shutil.rmtree(local, ignore_errors=True)


def release_staged() -> int:
    """Delete every folder staged by ``materialize`` in this process; returns how many."""
    with _LOCK:
        staged = list(_STAGED)
        _STAGED.clear()
    for spark, path in staged:
        discard(spark, path)
    return len(staged)


atexit.register(release_staged)
