"""The fixture tables as delimited files on disk, for tests that load files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.functions.hashing import row_hash
from curdle.plans.bronze import business_columns, normalize_rows
from curdle.sources.fixtures import FIXTURE_FILES
from curdle.sources.manifest import SourceSpec, spec_for_file


def _in_line_order(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The raw rows with ``_line``, the content hash that fixture files are ordered by."""
    packed = df.withColumn("_packed", F.struct("*"))
    normal = normalize_rows(packed, spec)
    return normal.select("_packed.*", row_hash(business_columns(normal)).alias("_line"))


def write_fixture_files(spark: SparkSession, sf_dir: str, raw_root: str) -> list[str]:
    """Write the fixture files as delimited text, one folder per ingestion run.

    ``raw_root/batch=<n>/<file>`` holds the rows of run n with the file's own
    header names and delimiter. Returns the run folders in order.
    """
    import os

    from curdle.sources.manifest import COLLECTION_LAYOUTS

    runs: dict[int, str] = {}
    for file, build in FIXTURE_FILES.items():
        spec = spec_for_file(file)
        df = build(spark, sf_dir)
        header = {v: k for k, v in COLLECTION_LAYOUTS.get(spec.source_format or "", {}).items()}
        df = _in_line_order(df, spec)
        batches = sorted(r[0] for r in df.select("_batch").distinct().collect())
        for b in batches:
            folder = runs.setdefault(b, os.path.join(raw_root, f"batch={b}"))
            rows = df.where(F.col("_batch") == b).drop("_batch")
            rows = rows.select(*[F.col(c).alias(header.get(c, c)) for c in rows.columns])
            (
                rows.coalesce(1).sortWithinPartitions("_line").drop("_line")
                .write.mode("overwrite")
                .option("header", True)
                .option("sep", spec.delimiter)
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
                .csv(os.path.join(folder, file))
            )
    return [runs[b] for b in sorted(runs)]
