"""Access to the given Parquet test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one test table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
