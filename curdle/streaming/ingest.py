"""Ingest files as they arrive, with Structured Streaming.

Each manifest entry's folder is watched by a file stream. ``Trigger.AvailableNow``
processes every file that arrived since the last run and stops, so a scheduled
job loads new files exactly once: the stream's checkpoint (under
``spark.checkpoint.dir``) records which files were taken, and each micro-batch
goes through the same bronze load as a batch run (``load_rows``), with the
micro-batch id as the load's run id. A re-executed micro-batch rewrites only its
own partition, so retries do not duplicate rows.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curdle.plans.ingest import load_rows
from curdle.sources.csv import CORRUPT, read_header
from curdle.sources.manifest import SourceSpec
from curdle.sources.records import logical_records, parse_records


def file_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming scan of the physical lines of new files in ``folder``, with their file and split."""
    at = F.col("_metadata")
    lines = spark.readStream.option("lineSep", "\n").text(folder)
    return lines.select("value", at["file_path"].alias("file"), at["file_block_start"].alias("block"))


def checkpoint_path(spark: SparkSession, raw_dir: str, spec: SourceSpec, warehouse: str) -> str:
    """Where a stream records which files it took: one place for each warehouse and raw folder.

    It must outlive the session, so ``spark.checkpoint.dir`` has to be set.
    """
    durable = spark.conf.get("spark.checkpoint.dir", None)
    if not durable:
        raise RuntimeError("set spark.checkpoint.dir: a stream's progress must outlive the session")
    where = hashlib.sha256(f"{warehouse.rstrip('/')}\n{raw_dir.rstrip('/')}".encode()).hexdigest()[:24]
    return os.path.join(durable, "curdle", "streams", where, spec.table, spec.file)


def start_ingestion(
    spark: SparkSession, raw_dir: str, spec: SourceSpec, warehouse: str, run_base: int = 1_000_000
) -> StreamingQuery | None:
    """Start an AvailableNow stream for one manifest entry (None while its folder has no file yet).

    Micro-batch ``n`` is loaded as run ``run_base + n`` so streamed loads never
    share a partition with batch runs.
    """
    folder = os.path.join(raw_dir, spec.file)
    header = read_header(spark, folder, spec.delimiter)
    if header is None:
        return None

    def load(batch: DataFrame, epoch_id: int) -> None:
        lines = batch.withColumn("line", F.monotonically_increasing_id())
        raw = parse_records(logical_records(lines, spec.delimiter), header, spec.delimiter, CORRUPT)
        row = load_rows(batch.sparkSession, raw, spec, warehouse, run_base + epoch_id)
        if row["status"] != "SUCCESS":  # the micro-batch must not be committed: the next run takes its files again
            raise RuntimeError(f"load of {spec.file} failed: {row['error_msg']}")

    return (
        file_stream(spark, folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path(spark, raw_dir, spec, warehouse))
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(spark: SparkSession, raw_dir: str, specs: list[SourceSpec], warehouse: str) -> int:
    """Run the AvailableNow streams of ``specs`` to completion; returns how many ran."""
    ran = 0
    for spec in specs:
        q = start_ingestion(spark, raw_dir, spec, warehouse)
        if q is not None:
            q.awaitTermination()
            ran += 1
    return ran
