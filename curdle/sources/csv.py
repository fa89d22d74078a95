"""Delimited-file scan with the raw layer's text semantics.

* header row binds columns by name; every column is read as text (no inference);
* an empty field is the empty string '' (Spark's CSV reader yields null for
  empty fields, so well-formed rows get '' back);
* a row with too few fields keeps those it has, the rest null; other malformed
  rows are set apart with their raw line (``judge_rows``);
* a quoted field may hold line breaks; a file that has one is read by ``records``, which keeps it split;
* a missing file is reported, not fatal.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curdle.sources.records import has_quoted_breaks, logical_records, parse_records, physical_lines

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def read_header(spark: SparkSession, path: str, delimiter: str = ",") -> list[str] | None:
    """Column names from the header line, or None when the path does not exist."""
    try:
        return (
            spark.read.option("header", True).option("sep", delimiter).option("inferSchema", False).csv(path).columns
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def read_delimited(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame | None:
    """All-text scan of one delimited file (or folder of part files).

    Returns the header's columns plus ``_corrupt_record`` (the raw text of a malformed
    row, else null), or None when the path is missing. Where a quoted field holds a line
    break, ``_line`` (the row's order) and ``_lost`` (the text of a line whose record never
    ends) come with them; finding out costs a scan of the text that stops at the first break.
    """
    header = read_header(spark, path, delimiter)
    if header is None:
        log.warning("source file not found, skipped: %s", path)
        return None
    lines = physical_lines(spark, path)
    if has_quoted_breaks(lines, delimiter):
        return parse_records(logical_records(lines, delimiter), header, delimiter, CORRUPT)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        # Malformed rows are judged over all columns, whatever a query reads.
        .option("columnPruning", False)
        .csv(path)
    )


_END = "\u0001"


def judge_rows(df: DataFrame, delimiter: str = ",", keep_surplus: bool = False) -> DataFrame:
    """The header's columns and ``_quarantined``: the raw line of a row that cannot be loaded, else null.

    * a row with the header's field count loads, empty fields as '';
    * a shorter row loads, the fields it lacks as null;
    * a longer row loads without its surplus where ``keep_surplus`` is set, else it is quarantined;
    * a row with a broken quote is quarantined, and so is each line of a record whose quote never closes;
      a ``_line`` column passes through.

    A malformed line is parsed once more with an end mark behind it: the field that
    holds the mark tells how many the line has; a mark inside a field tells of a
    quote that never closes.
    """
    business = [c for c in df.columns if c not in (CORRUPT, "_line", "_lost")]
    if not business:
        return df.select(F.col(CORRUPT).alias("_quarantined"))
    line = [F.col("_line")] if "_line" in df.columns else []
    lost = F.col("_lost") if "_lost" in df.columns else F.lit(None).cast("string")
    names = [f"f{i}" for i in range(len(business) + 1)]
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    marked = F.concat(F.col(CORRUPT), F.lit(delimiter + _END))
    again = F.from_csv(marked, ", ".join(f"{n} string" for n in names), options)
    df = df.withColumn("_fields", F.when(F.col(CORRUPT).isNotNull(), F.array(*[again[n] for n in names])))
    at = F.array_position("_fields", F.lit(_END))
    n_fields = F.when(at > 0, at - 1).otherwise(F.lit(len(names)))
    broken = F.exists("_fields", lambda f: f.contains(_END) & (f != _END))
    df = df.withColumn("_n", F.when(lost.isNotNull(), F.lit(-1)).when(F.col(CORRUPT).isNull(), F.lit(len(business))).when(F.coalesce(broken, F.lit(False)), F.lit(-1)).otherwise(n_fields))
    loads = (F.col("_n") >= 0) & (F.lit(keep_surplus) | (F.col("_n") <= len(business)))
    fields = [F.when(loads & (F.col("_n") > i), F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for i, c in enumerate(business)]
    return df.select(*fields, *line, F.when(~loads, F.coalesce(lost, CORRUPT)).alias("_quarantined"))
