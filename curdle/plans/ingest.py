"""Raw files → bronze tables, one manifest entry at a time.

Per file: scan (all text) → judge malformed rows → normalise → hash and stamp →
write the rows to a folder of their own → flag against the hashes of earlier loads →
write the load's hashes and its unloadable rows to folders of their own, and its rows once
more where any are flagged or unloadable → switch the catalog to them in one commit →
append one log row. The file is parsed once; every count is observed while rows are written.

Loads are ordered by (run, place in the manifest). A row is a duplicate iff an
earlier load, or an earlier row of its own load, has its content; when a load stood
is irrelevant. So a load that is run again is compared with earlier loads only, and
later loads whose flags depend on it are flagged anew, in the same commit. A load that
fails, at whatever step, leaves rows, hashes, flags and quarantine as they were.

Each table has a side table (layer ``bronze_keys``) with the distinct hashes of every load
and each hash's first row, bucketed by hash: what is stored is compared bucket to bucket
and never shuffled, and the rows themselves are not read.
"""

from __future__ import annotations

import logging
import os
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curdle.operators.dedup import DUP, HASH, mark_repeats, repeats
from curdle.operators.materialize import discard, stage
from curdle.plans.bronze import load_position, normalize_rows, rename_layout_headers, stamp
from curdle.sources import files
from curdle.sources.catalog import table_path
from curdle.sources.csv import judge_rows, read_delimited
from curdle.sources.manifest import SourceSpec
from curdle.sources.store import CODEC, COMPACTED, FILE, RUN, Change, Column, Store

log = logging.getLogger(__name__)

LOG_TABLE = "ingestion_log"
LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("_batch_id", T.LongType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_skipped", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


QUARANTINE_TABLE = "quarantine"
QUARANTINE_COLUMNS = [Column("table_name"), Column("raw_line"), Column("ingested_at", "timestamp")]
QUARANTINE_SCHEMA = "table_name string, raw_line string, ingested_at timestamp, _batch_id bigint, _source_file string"
BRONZE, KEYS = "bronze", "bronze_keys"
#: Columns of every bronze table beside those of its files, and of its side table.
LINEAGE = [Column("_row_id", "bigint"), Column(HASH), Column("_source_format"), Column("_ingested_at", "timestamp"), Column(DUP, "boolean")]
KEY_COLUMNS = [Column(HASH), Column("_row_id", "bigint")]


def has_rows(spark: SparkSession, warehouse: str, table: str) -> bool:
    store = Store(spark, warehouse)
    return store.exists(BRONZE, table) and bool(store.loads(BRONZE, table))


def read_bronze(spark: SparkSession, warehouse: str, table: str) -> DataFrame | None:
    """The stored bronze table, with every column that a load has brought so far; None while it has no rows."""
    return Store(spark, warehouse).read(BRONZE, table) if has_rows(spark, warehouse, table) else None


def read_keys(spark: SparkSession, warehouse: str, table: str) -> DataFrame | None:
    """(hash, first row of the load that has it, load): the side table."""
    store = Store(spark, warehouse)
    return store.read(KEYS, table) if store.exists(KEYS, table) else None


def schema_history(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """(column_name, position, added_by): a bronze table's columns and the load that brought each."""
    columns = Store(spark, warehouse).columns(BRONZE, table)
    return spark.createDataFrame([(c.name, i, c.added_by) for i, c in enumerate(columns, 1)], "column_name string, position int, added_by string")


def load_file(spark: SparkSession, raw_dir: str, spec: SourceSpec, warehouse: str, batch_id: int) -> dict | None:
    """Load one manifest entry for run ``batch_id``; returns its log row (None if the file is missing)."""
    try:
        raw = read_delimited(spark, os.path.join(raw_dir, spec.file), spec.delimiter)
    except Exception as e:  # noqa: BLE001 — an unreadable file is logged like any failed load
        return _log_failure(spark, warehouse, spec, batch_id, e, time.monotonic(), _now())
    if raw is None:
        return None
    return load_rows(spark, raw, spec, warehouse, batch_id)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def load_rows(spark: SparkSession, raw: DataFrame, spec: SourceSpec, warehouse: str, batch_id: int) -> dict:
    """Load already-scanned raw rows (header columns + ``_corrupt_record``) as one bronze load."""
    started, ingested_at = time.monotonic(), _now()
    attempt = _Attempt(Store(spark, warehouse), spec, batch_id)
    undo = None
    try:
        attempt.check_order()
        judged = judge_rows(raw, spec.delimiter, keep_surplus=spec.source_format is not None)
        if spec.source_format:
            judged = rename_layout_headers(judged, spec.source_format)
        counts = attempt.write(judged, ingested_at)
        undo = attempt.store.commit(attempt.changes)
        row = _log_row(spec, batch_id, ingested_at)
        row.update(
            rows_read=counts["n"],
            rows_skipped=counts["dup"],
            rows_inserted=counts["n"] - counts["dup"],
            rows_quarantined=counts["bad"],
            duration_ms=int((time.monotonic() - started) * 1000),
            status="SUCCESS",
            error_msg=None,
        )
        append_log(spark, warehouse, row)
        return row
    except Exception as e:  # noqa: BLE001 — one bad file must not stop the run; it is logged
        if undo is not None:
            undo()
        attempt.discard()
        return _log_failure(spark, warehouse, spec, batch_id, e, started, ingested_at)
    finally:
        attempt.close()


class _Attempt:
    """One attempt to load: everything it writes lies in folders that nothing names before the commit."""

    def __init__(self, store: Store, spec: SourceSpec, batch_id: int) -> None:
        self.store, self.spark, self.spec, self.load = store, store.spark, spec, (batch_id, spec.file)
        self.changes: list[Change] = []
        self._staged: list[str] = []
        self._names: list[str] = []

    def check_order(self) -> None:
        """A compaction has dropped later copies of what this load holds, so it cannot be taken back."""
        done = [tuple(e[COMPACTED]) for e in self.store.journal() if COMPACTED in e and e["table"] == self.spec.table]
        if done and self.load in self.store.loads(BRONZE, self.spec.table) and load_place(self.load, self.spec.table) <= max(load_place(x, self.spec.table) for x in done):
            raise ValueError(f"{self.spec.table} was compacted after run {self.load[0]} of {self.load[1]}: it cannot be loaded again")

    def write(self, judged: DataFrame, ingested_at: datetime) -> dict:
        """Write the load's rows, hashes and unloadable rows; returns its counts."""
        table, counts = self.spec.table, {"n": 0, "dup": 0, "bad": 0}
        if len([c for c in judged.columns if not c.startswith("_")]):
            stamped = stamp(normalize_rows(judged, self.spec), self.spec, F.lit(ingested_at).cast("timestamp"), F.lit(self.load[0]), ["_quarantined"])
            counts |= self._write_first(stamped)
            staged = self.spark.read.schema(self._schema).parquet(self._first)
        if counts["bad"]:
            self._quarantine(staged.where(F.col("_quarantined").isNotNull()))
        elif self._has(BRONZE, QUARANTINE_TABLE):
            self.changes.append(Change(BRONZE, QUARANTINE_TABLE, None, self.load))
        if counts["n"]:
            counts["dup"] = self._rows(staged.where(F.col("_quarantined").isNull()).drop("_quarantined", DUP), counts["n"], not counts["bad"])
        elif self._has(BRONZE, table):
            self.changes += [Change(BRONZE, table, None, self.load), Change(KEYS, table, None, self.load)]
            self._reflag(self.spark.createDataFrame([], f"{HASH} string, _row_id bigint"))
        return counts

    def _write_first(self, stamped: DataFrame) -> dict:
        """Write the stamped rows, none of them flagged, where they stay unless some are flagged or unloadable; returns how many load and how many do not."""
        table, seen = self.spec.table, Observation()
        known = {c.name.lower(): c.name for c in self.store.columns(BRONZE, table)} if self.store.exists(BRONZE, table) else {}
        rows = stamped.select(*[F.col(f"`{c}`").alias(known.get(c.lower(), c)) for c in stamped.columns if c not in (RUN, FILE)]).withColumn(DUP, F.lit(False))
        self._first, self._schema = self.store.new_folder(BRONZE, table), rows.schema
        self._staged.append(self._first)
        observed = rows.observe(seen, F.count_if(F.col("_quarantined").isNull()).alias("n"), F.count("_quarantined").alias("bad"))
        observed.write.option("compression", CODEC).parquet(self._first)
        return {"n": seen.get["n"], "bad": seen.get["bad"]}

    def _has(self, layer: str, table: str) -> bool:
        return self.store.exists(layer, table) and self.load in self.store.loads(layer, table)

    def _define(self, rows: DataFrame) -> None:
        """The table, its side table, and the columns that this load is the first to bring."""
        table, by = self.spec.table, f"run {self.load[0]}, {self.load[1]}"
        own = [Column(c, "string", by) for c in rows.columns if not c.startswith("_")]
        if not self.store.exists(BRONZE, table):
            self.store.create(BRONZE, table, own + LINEAGE, parts="load")
        if not self.store.exists(KEYS, table):
            self.store.create(KEYS, table, KEY_COLUMNS, parts="load", buckets=int(self.spark.conf.get("spark.sql.shuffle.partitions")), key=HASH)
        known = {c.name.lower() for c in self.store.columns(BRONZE, table)}
        if new := [c for c in own if c.name.lower() not in known]:
            self.store.add_columns(BRONZE, table, new)

    def _rows(self, good: DataFrame, n: int, all_good: bool) -> int:
        """Write flagged rows and hashes; returns how many of the ``n`` rows are duplicates.

        Only places of duplicates are looked for, in narrow rows: the rows themselves meet them where there are any,
        by broadcast while they are few. Rows that are ``all_good`` and hold none stay as they were first written.
        """
        table = self.spec.table
        self._define(good)
        firsts = good.groupBy(HASH).agg(F.min("_row_id").alias("_row_id"))
        seen = Observation()
        keys, name = self.store.write_bucketed(firsts.observe(seen, F.count(F.lit(1)).alias("n")), KEY_COLUMNS, HASH, self.store.buckets(KEYS, table), KEYS, table)
        self._names.append(name)
        own = new = self.spark.table(name)
        n_new = seen.get["n"]
        if any(load_place(x, table) < load_place(self.load, table) for x in self.store.loads(KEYS, table)):
            new = own.join(self._stored(_before(self.spec, self.load)).select(HASH), HASH, "left_anti")
            n_new = new.count()
        if n_new < n:
            again, path = stage(repeats(good, new, ["_row_id"]), f"repeats-{table}")
            self._staged.append(path)
            place, flagged = self._write_rows(mark_repeats(good, again, ["_row_id"]))
        elif all_good:
            place, flagged = self._first, 0
            self._staged.remove(place)
        else:
            place, flagged = self._write_rows(good.withColumn(DUP, F.lit(False)))
        self.changes += [Change(BRONZE, table, place, self.load), Change(KEYS, table, keys, self.load)]
        self._reflag(own)
        return flagged

    def _write_rows(self, rows: DataFrame) -> tuple[str, int]:
        """Write rows in the table's columns; returns the folder and the number of flagged ones."""
        have = {c.lower() for c in rows.columns}
        columns = [c.name for c in self.store.columns(BRONZE, self.spec.table) if c.name.lower() in have]
        place, seen = self.store.new_folder(BRONZE, self.spec.table), Observation()
        rows.select(*[F.col(f"`{c}`").alias(c) for c in columns]).observe(seen, F.count_if(DUP).alias("dup")).write.option("compression", CODEC).parquet(place)
        return place, seen.get["dup"]

    def _stored(self, where) -> DataFrame:
        return self.store.read(KEYS, self.spec.table).where(where)

    def _reflag(self, own: DataFrame) -> None:
        """Write anew the later loads whose flags change, now that this load holds the hashes ``own``.

        Only hashes that come or go with this load matter, and of them those that no earlier load has:
        the first later load with such a hash is a copy now, or no longer one.
        """
        table = self.spec.table
        loads = self.store.loads(KEYS, table)
        if not any(load_place(x, table) > load_place(self.load, table) for x in loads):
            return
        old = self._stored((F.col(RUN) == self.load[0]) & (F.col(FILE) == self.load[1])).select(HASH)
        delta = own.join(old, HASH, "left_anti").select(HASH, F.lit(True).alias("_copy")).unionByName(
            old.join(own, HASH, "left_anti").select(HASH, F.lit(False).alias("_copy"))
        )
        delta = delta.join(self._stored(_before(self.spec, self.load)).select(HASH), HASH, "left_anti")
        later = self._stored(_after(self.spec, self.load)).withColumn("_position", load_position(table))
        first = later.groupBy(HASH).agg(F.min(F.struct(RUN, "_position", FILE, "_row_id")).alias("f")).select(HASH, "f.*")
        changed, path = stage(first.join(delta, HASH).select(HASH, RUN, FILE, "_row_id", "_copy"), f"reflag-{table}")
        self._staged.append(path)
        for run, file in sorted((r[RUN], r[FILE]) for r in changed.select(RUN, FILE).distinct().collect()):
            mine = (F.col(RUN) == run) & (F.col(FILE) == file)
            flags = changed.where(mine).select(HASH, "_row_id", "_copy")
            rows = self.store.read(BRONZE, table).where(mine).join(flags, [HASH, "_row_id"], "left").withColumn(DUP, F.coalesce("_copy", DUP))
            place, _ = self._write_rows(rows)
            self.changes.append(Change(BRONZE, table, place, (run, file)))

    def _quarantine(self, bad: DataFrame) -> None:
        if not self.store.exists(BRONZE, QUARANTINE_TABLE):
            self.store.create(BRONZE, QUARANTINE_TABLE, QUARANTINE_COLUMNS, parts="load")
        place = self.store.new_folder(BRONZE, QUARANTINE_TABLE)
        bad.select(F.lit(self.spec.table).alias("table_name"), F.col("_quarantined").alias("raw_line"), F.col("_ingested_at").alias("ingested_at")).write.parquet(place)
        self.changes.append(Change(BRONZE, QUARANTINE_TABLE, place, self.load))

    def discard(self) -> None:
        """Remove what a failed attempt has written."""
        for c in self.changes:
            if c.location:
                discard(self.spark, c.location)

    def close(self) -> None:
        for name in self._names:
            self.store.forget(name)
        for path in self._staged:
            discard(self.spark, path)


def load_place(load: tuple[int, str], table: str) -> tuple[int, int]:
    from curdle.sources.manifest import spec_for_file

    return load[0], spec_for_file(load[1]).position


def _before(spec: SourceSpec, load: tuple[int, str]):
    """Loads that stand before this one; a filter on partitions."""
    return (F.col(RUN) < load[0]) | ((F.col(RUN) == load[0]) & (load_position(spec.table) < spec.position))


def _after(spec: SourceSpec, load: tuple[int, str]):
    return (F.col(RUN) > load[0]) | ((F.col(RUN) == load[0]) & (load_position(spec.table) > spec.position))


def compact(spark: SparkSession, warehouse: str, table: str) -> int:
    """Write a bronze table anew without its flagged copies, in one commit; returns the rows removed.

    Loads only ever append and flag; this optional step drops the flagged rows. A load that stood
    then can no longer be loaded again: a copy of what it would take back may be gone.
    """
    store = Store(spark, warehouse)
    if not has_rows(spark, warehouse, table):
        return 0
    bronze, changes, removed = store.read(BRONZE, table), [], 0
    flagged = bronze.where(DUP).groupBy(RUN, FILE).count().collect()  # a row a load
    for r in flagged:
        place = store.new_folder(BRONZE, table)
        bronze.where((F.col(RUN) == r[RUN]) & (F.col(FILE) == r[FILE]) & ~F.col(DUP)).drop(RUN, FILE).write.parquet(place)
        changes.append(Change(BRONZE, table, place, (r[RUN], r[FILE])))
        removed += r["count"]
    if changes:
        last = max(store.loads(BRONZE, table), key=lambda x: load_place(x, table))
        store.commit(changes)
        store.note_compaction(table, last)
    return removed


def read_quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rows that could not load: table, raw line, load time, run and file."""
    rows = read_bronze(spark, warehouse, QUARANTINE_TABLE)
    return spark.createDataFrame([], QUARANTINE_SCHEMA) if rows is None else rows


def _log_row(spec: SourceSpec, batch_id: int, ingested_at: datetime) -> dict:
    return {
        "table_name": spec.table,
        "source_file": spec.file,
        "_batch_id": batch_id,
        "rows_updated": 0,
        "ingested_at": ingested_at,
    }


def _log_failure(spark, warehouse, spec, batch_id, error, started, ingested_at) -> dict:
    log.error("load of %s failed: %s", spec.file, error)
    row = _log_row(spec, batch_id, ingested_at)
    row.update(rows_read=None, rows_inserted=None, rows_skipped=None, rows_quarantined=None)
    row.update(status="ERROR", error_msg=str(error), duration_ms=int((time.monotonic() - started) * 1000))
    append_log(spark, warehouse, row)
    return row


def append_log(spark: SparkSession, warehouse: str, row: dict) -> None:
    values = [row.get(f.name) for f in LOG_SCHEMA.fields]
    spark.createDataFrame([values], LOG_SCHEMA).write.mode("append").parquet(
        table_path(warehouse, "bronze", LOG_TABLE)
    )


def read_log(spark: SparkSession, warehouse: str) -> DataFrame:
    """The ingestion log ordered by load time; empty before the first load."""
    path = table_path(warehouse, "bronze", LOG_TABLE)
    if not files.exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path).orderBy("ingested_at")
