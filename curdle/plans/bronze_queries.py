"""Bronze-layer queries over the fixture loads (whole files, every run)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.functions.dates import normalize_date
from curdle.functions.text import numeric_like
from curdle.operators.ordering import with_row_number
from curdle.plans.bronze import fixture_bronze, fixture_flags
from curdle.plans.ingest import BRONZE, KEYS, load_file, load_rows, read_bronze, read_log, schema_history
from curdle.session import scratch_path
from curdle.sources.csv import CORRUPT, judge_rows
from curdle.sources.fixtures import FIXTURE_FILES
from curdle.sources.manifest import BRONZE_TABLES, COLLECTION_LAYOUTS, COLLECTION_NUMERIC_LIKE, COLLECTION_WIDE_COLUMNS, MANIFEST, spec_for_file
from curdle.sources.store import Store
from curdle.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def b01_normalize_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every manifest date value of every file, raw and normalised."""
    parts = []
    for spec in MANIFEST:
        if not spec.date_cols:
            continue
        raw = FIXTURE_FILES[spec.file](spark, sf_dir)
        for col in spec.date_cols:
            parts.append(
                raw.select(
                    F.lit(spec.file).alias("source_file"),
                    F.col(spec.key).alias("record_key"),
                    F.col("_batch").cast("bigint").alias("_batch_id"),
                    F.lit(col).alias("column_name"),
                    F.col(col).alias("raw_value"),
                    normalize_date(F.col(col)).alias("normalized"),
                )
            )
    return _union(parts)


def b02_numeric_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal-comma clean-up of the collection measures of layouts B and C."""
    parts = []
    for spec in MANIFEST:
        cols = COLLECTION_NUMERIC_LIKE.get(spec.source_format or "", ())
        if not cols:
            continue
        raw = FIXTURE_FILES[spec.file](spark, sf_dir)
        key = "collection_id" if spec.source_format == "fonte_b" else "c_coleta_id"
        for col in cols:
            parts.append(
                raw.select(
                    F.lit(spec.file).alias("source_file"),
                    F.col(key).alias("record_key"),
                    F.lit(col).alias("column_name"),
                    F.col(col).alias("raw_value"),
                    numeric_like(F.col(col)).alias("cleaned"),
                )
            )
    return _union(parts)


def b03_unify_collection_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three collection layouts as one wide bronze table."""
    b = fixture_bronze(spark, sf_dir, "coletas", flag=False)
    return b.select(*COLLECTION_WIDE_COLUMNS, "_source_format", "_source_file", "_batch_id", "_row_hash")


def b04_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["_source_file", "_batch_id", "_row_hash"]
    return _union([fixture_bronze(spark, sf_dir, t, flag=False).select(F.lit(t).alias("table_name"), *cols) for t in BRONZE_TABLES])


def b05_flag_duplicates_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union([fixture_flags(spark, sf_dir, t).select(F.lit(t).alias("table_name"), "*") for t in BRONZE_TABLES])


def _load(spark: SparkSession, raw: DataFrame, file: str, warehouse: str, run: int) -> None:
    """Rows of one file through the load path; a failed load is an error here."""
    row = load_rows(spark, raw.withColumn(CORRUPT, F.lit(None).cast("string")), spec_for_file(file), warehouse, run)
    if row["status"] != "SUCCESS":
        raise RuntimeError(row["error_msg"])


def _in_file_headers(raw: DataFrame, file: str) -> DataFrame:
    """Fixture columns under the names that the file's header has."""
    header = {v: k for k, v in COLLECTION_LAYOUTS.get(spec_for_file(file).source_format or "", {}).items()}
    return raw.select(*[F.col(c).alias(header.get(c, c)) for c in raw.columns])


def b06_incremental_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs 1 and 2 of the orders file through the load path: run 2 as flagged against the hashes that run 1 has stored."""
    warehouse = scratch_path(spark, f"curdle/b06-{uuid.uuid4().hex}")
    raw = FIXTURE_FILES["pedidos.csv"](spark, sf_dir)
    for run in (1, 2):
        _load(spark, raw.where(F.col("_batch") == run).drop("_batch"), "pedidos.csv", warehouse, run)
    return read_bronze(spark, warehouse, "pedidos").where("_batch_id = 2").select("id_pedido", "status", "_row_hash", "_is_duplicate")


def b07_ingestion_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of every run through the load path, in order, and the log that this leaves; times are left out (not deterministic)."""
    warehouse = scratch_path(spark, f"curdle/b07-{uuid.uuid4().hex}")
    raw = {spec.file: FIXTURE_FILES[spec.file](spark, sf_dir) for spec in MANIFEST}
    brings = {(r[0], file) for file, found in raw.items() for r in found.select("_batch").distinct().collect()}  # a run need not bring every file
    loads = [(run, spec) for run in sorted({run for run, _ in brings}) for spec in MANIFEST if (run, spec.file) in brings]
    store = Store(spark, warehouse)
    for i, (run, spec) in enumerate(loads, 1):
        _load(spark, _in_file_headers(raw[spec.file].where(F.col("_batch") == run).drop("_batch"), spec.file), spec.file, warehouse, run)
        if all(later.table != spec.table for _, later in loads[i:]):  # no load compares itself with its rows any more, and the log alone is read
            store.drop(BRONZE, spec.table)
            store.drop(KEYS, spec.table)
    log = with_row_number(read_log(spark, warehouse), [F.col("ingested_at")])  # writes it anew
    store.remove([BRONZE, KEYS])
    return log.drop("duration_ms", "ingested_at")


def b08_schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw collection files appended by column name; columns a file lacks are null."""
    parts = []
    for spec in MANIFEST:
        if spec.table == "coletas":
            raw = FIXTURE_FILES[spec.file](spark, sf_dir)
            parts.append(raw.withColumn("_source_file", F.lit(spec.file)))
    return _union(parts).withColumn("_batch", F.col("_batch").cast("bigint"))


def b09_rerun_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded by the load path as runs 1 and 2, then run 1 once more: flags follow the order of runs."""
    warehouse = scratch_path(spark, f"curdle/b09-{uuid.uuid4().hex}")
    raw = FIXTURE_FILES["pedidos.csv"](spark, sf_dir)
    for run in (1, 2, 1):
        _load(spark, raw.where(F.col("_batch") == run).drop("_batch"), "pedidos.csv", warehouse, run)
    return read_bronze(spark, warehouse, "pedidos").select("id_pedido", "status", "_batch_id", "_row_hash", "_is_duplicate")


_ORDER_LINE = ", ".join(f"{c} string" for c in ("id_pedido", "cliente", "nota", "total", CORRUPT))


def b10_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines of every order, some short, long or with an open quote: what loads, and what is set apart."""
    k = F.col("o_orderkey")
    head = F.concat(k.cast("string"), F.lit(";"), F.col("o_custkey").cast("string"))
    line = (
        F.when(k % 11 == 1, head)
        .when(k % 11 == 2, F.concat(head, F.lit(";;")))
        .when(k % 11 == 3, F.concat(head, F.lit(";a;b;c;")))
        .when(k % 11 == 4, F.concat(head, F.lit(';"open;1')))
        .otherwise(F.concat(head, F.lit(';"x; y";'), F.floor("o_totalprice").cast("string")))
    )
    options = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = read_table(spark, sf_dir, "orders").select(F.from_csv(line, _ORDER_LINE, options).alias("r"))
    return judge_rows(lines.select("r.*"), ";").withColumnRenamed("_quarantined", "quarantined")


def b11_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a row of a customer file with breaks, quotes and delimiters inside its fields, loaded by the load path."""
    k = F.col("o_orderkey")
    note = (
        F.when(k % 5 == 0, F.concat_ws("\n", F.lit("Cliente"), "o_orderstatus", F.lit("fim")))
        .when(k % 5 == 1, F.concat(F.lit('"'), "o_orderpriority", F.lit('",\n"\n')))
        .when(k % 5 == 2, F.concat(F.lit("\n\n"), k.cast("string")))
        .otherwise(F.concat(F.lit("nome, "), k.cast("string")))
    )
    orders = read_table(spark, sf_dir, "orders")
    rows = orders.select(k.cast("string").alias("id_cliente"), note.alias("nome_cliente"), F.when(k % 3 == 0, F.concat(F.lit("a\r\n"), "o_orderstatus")).otherwise(F.lit("")).alias("cidade"))
    home = scratch_path(spark, f"curdle/b11-{uuid.uuid4().hex}")
    spec = spec_for_file("clientes.csv")
    rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{home}/raw/{spec.file}")
    row = load_file(spark, f"{home}/raw", spec, f"{home}/lake", 1)
    if row["status"] != "SUCCESS":
        raise RuntimeError(row["error_msg"])
    return read_bronze(spark, f"{home}/lake", spec.table).select("id_cliente", "nome_cliente", "cidade", "_row_hash", "_is_duplicate")


def b12_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs of the customer file, two of which bring a new column: one table, and which run brought what."""
    warehouse = scratch_path(spark, f"curdle/b12-{uuid.uuid4().hex}")
    people = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id_cliente"), F.col("c_name").alias("nome_cliente"), F.col("c_nationkey").cast("string").alias("cidade"), F.col("c_mktsegment").alias("segmento")
    )
    runs = {1: people.drop("cidade", "segmento"), 2: people.drop("segmento"), 3: people.where(F.col("id_cliente").cast("long") % 2 == 0), 4: people.drop("segmento")}
    for run, rows in runs.items():
        _load(spark, rows, "clientes.csv", warehouse, run)
    added = schema_history(spark, warehouse, "clientes").where("added_by <> ''").withColumn("run", F.regexp_extract("added_by", r"run (\d+)", 1).cast("int"))
    named = added.agg(F.array_sort(F.collect_list(F.struct("run", "column_name"))).alias("v"))  # a table's columns
    by_run = named.select(F.concat_ws(",", F.transform("v", lambda x: F.concat_ws("=", x["column_name"], x["run"].cast("string")))).alias("columns_by_run"))
    rows = read_bronze(spark, warehouse, "clientes").select("id_cliente", "nome_cliente", "cidade", "segmento", "_batch_id", "_row_hash", "_is_duplicate")
    return rows.withColumn("columns_by_run", F.lit(by_run.first()[0]))


BRONZE_QUERIES: dict[str, Query] = {
    "b01_normalize_date": b01_normalize_date,
    "b02_numeric_like": b02_numeric_like,
    "b03_unify_collection_formats": b03_unify_collection_formats,
    "b04_row_hash": b04_row_hash,
    "b05_flag_duplicates_in_batch": b05_flag_duplicates_in_batch,
    "b06_incremental_hash_dedup": b06_incremental_hash_dedup,
    "b07_ingestion_log": b07_ingestion_log,
    "b08_schema_evolution_union": b08_schema_evolution_union,
    "b09_rerun_flags": b09_rerun_flags,
    "b10_malformed_rows": b10_malformed_rows,
    "b11_quoted_breaks": b11_quoted_breaks,
    "b12_schema_versions": b12_schema_versions,
}
