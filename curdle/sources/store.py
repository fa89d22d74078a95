"""Tables whose content is switched by catalog location.

Every write goes to a folder of its own, by Spark's own commit protocol, and nobody reads it
until the catalog names it: a partition's location (loads) or a table's location (models) is the
one thing that changes. A write that fails, at whatever step, leaves an unnamed folder behind
and the earlier rows where they were; readers keep the files they began with.

One commit may switch several partitions. If a later one of them fails, the earlier ones are
switched back. After the catalog, the commit is noted in the warehouse as one small file
(``_journal``), put in place by a single rename: a session whose catalog does not outlive it
attaches the tables of a warehouse from these notes, and finds the state of the last whole
commit. Folders that no location names any more are removed by ``vacuum``.

Columns are held by the catalog with the load that added each (its comment), so no reader
merges schemas from files.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from curdle.sources import files
from curdle.sources.catalog import sql_str, table_path

#: Partition columns of loads.
RUN, FILE = "_batch_id", "_source_file"
#: Partition column of a table that is merged by key.
BUCKET = "_bucket"
#: How a table is partitioned → its partition columns.
PARTS = {"": (), "load": ((RUN, "bigint"), (FILE, "string")), "bucket": ((BUCKET, "int"),)}
Part = tuple[int, str] | tuple[int]
JOURNAL = "_journal"
#: Codec of rows and hashes that stay: hashes are hex text, of which this codec stores half the bytes.
CODEC = "zstd"
COMPACTED = "compacted"


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"
    added_by: str = ""


@dataclass(frozen=True)
class Change:
    """A table (or one partition of it) and the folder that holds its rows from now on; None: no rows."""

    layer: str
    table: str
    location: str | None
    load: Part | None = None


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _ddl(columns: Sequence[Column]) -> str:
    return ", ".join(f"{_quoted(c.name)} {c.type}" + (f" COMMENT '{sql_str(c.added_by)}'" if c.added_by else "") for c in columns)


def _partition(part: Part) -> str:
    return f"PARTITION ({RUN}={int(part[0])}, {FILE}='{sql_str(part[1])}')" if len(part) == 2 else f"PARTITION ({BUCKET}={int(part[0])})"


class Store:
    """The tables of one warehouse."""

    def __init__(self, spark: SparkSession, warehouse: str) -> None:
        self.spark, self.warehouse = spark, warehouse

    # ── names ────────────────────────────────────────────────────────────────

    def database(self, layer: str) -> str:
        """The layer's database: plainly named, unless that name belongs to another warehouse of this catalog."""
        place = files.qualified(self.spark, os.path.join(self.warehouse, layer))
        own = f"{layer}_{hashlib.sha256(place.encode()).hexdigest()[:10]}"
        for name in (layer, own):
            if not self.spark.catalog.databaseExists(name):
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{sql_str(place)}'")
                return name
            if files.qualified(self.spark, self.spark.catalog.getDatabase(name).locationUri) == place:
                return name
        raise ValueError(f"database {own} lies elsewhere")

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{_quoted(table)}"

    def new_folder(self, layer: str, table: str, kind: str = "rows") -> str:
        """A folder for one attempt to write."""
        return os.path.join(table_path(self.warehouse, layer, table), f"{kind}-{uuid.uuid4().hex}")

    # ── definitions ──────────────────────────────────────────────────────────

    def exists(self, layer: str, table: str) -> bool:
        """Whether the catalog has the table; one that only the journal knows is attached first."""
        return self.spark.catalog.tableExists(self.name(layer, table)) or self._attach(layer, table)

    def create(self, layer: str, table: str, columns: Sequence[Column], parts: str = "", buckets: int = 0, key: str = "", place: str | None = None) -> None:
        """Define a table whose rows lie at ``place``; one with ``parts`` ("load" or "bucket") has none yet."""
        place = place or table_path(self.warehouse, layer, table)
        made = {"layer": layer, "table": table, "columns": [asdict(c) for c in columns], "parts": parts, "buckets": buckets, "key": key, "place": place}
        self._define(made)
        self._note([made])

    def _define(self, made: dict) -> None:
        columns, buckets, key = [Column(**c) for c in made["columns"]], made["buckets"], made["key"]
        by = [Column(*c) for c in PARTS[made["parts"]]]
        parts = f"PARTITIONED BY ({', '.join(c.name for c in by)})" if by else ""
        clustered = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS" if buckets else ""
        name, place = self.name(made["layer"], made["table"]), sql_str(made["place"])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl([*columns, *by])}) USING parquet {parts} {clustered} LOCATION '{place}'")

    def columns(self, layer: str, table: str) -> list[Column]:
        """The table's columns but its partition's, each with the load that added it."""
        fields = self.spark.table(self.name(layer, table)).schema.fields
        by = {c.name for c in self.spark.catalog.listColumns(self.name(layer, table)) if c.isPartition}
        return [Column(f.name, f.dataType.simpleString(), f.metadata.get("comment", "")) for f in fields if f.name not in by]

    def add_columns(self, layer: str, table: str, columns: Sequence[Column]) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({_ddl(columns)})")
        self._note([{"layer": layer, "table": table, "columns": [asdict(c) for c in columns], "added": True}])

    def buckets(self, layer: str, table: str) -> int:
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)}").where("col_name = 'Num Buckets'").collect()
        return int(rows[0]["data_type"]) if rows else 0

    # ── content ──────────────────────────────────────────────────────────────

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def loads(self, layer: str, table: str) -> list[Part]:
        """The loads (or buckets) that a table holds, from the catalog alone."""
        found = []
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name(layer, table)}").collect():
            first, *more = (unquote(x.split("=", 1)[1]) for x in r[0].split("/"))
            found.append((int(first), *more))
        return sorted(found)

    def is_partitioned(self, layer: str, table: str) -> bool:
        return any(c.isPartition for c in self.spark.catalog.listColumns(self.name(layer, table)))

    def location(self, layer: str, table: str, load: tuple[int, str] | None = None) -> str | None:
        if load is not None and load not in self.loads(layer, table):
            return None
        part = _partition(load) if load is not None else ""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)} {part}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def commit(self, changes: Sequence[Change], note: dict | None = None) -> Callable[[], None]:
        """Switch all places or none; returns a function that switches them back. ``note`` is kept with the commit."""
        done: list[Change] = []

        def undo(noted: bool = True) -> None:
            for c in reversed(done):
                self._switch(c)
            if noted:
                self._note([asdict(c) for c in done])

        try:
            for c in changes:
                before = Change(c.layer, c.table, self.location(c.layer, c.table, c.load), c.load)
                done.append(before)
                self._switch(c)
            self._note([asdict(c) for c in changes] + ([note] if note else []))
        except BaseException:
            undo(noted=False)
            raise
        return undo

    def _switch(self, c: Change) -> None:
        name = self.name(c.layer, c.table)
        if c.load is None:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{sql_str(c.location)}'")
        elif c.location is None:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_partition(c.load)}")
        elif c.load in self.loads(c.layer, c.table):
            self.spark.sql(f"ALTER TABLE {name} {_partition(c.load)} SET LOCATION '{sql_str(c.location)}'")
        else:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {_partition(c.load)} LOCATION '{sql_str(c.location)}'")
        self.spark.sql(f"REFRESH TABLE {name}")

    def write_table(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Write a whole table anew and switch to it in one step (two where its columns have changed)."""
        place = self.new_folder(layer, table)
        df.write.parquet(place)
        columns = [Column(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        if self.exists(layer, table):
            if not self.is_partitioned(layer, table) and [(f.name, f.dataType) for f in self.read(layer, table).schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]:
                self.commit([Change(layer, table, place)])
                return self.read(layer, table)
            self.spark.sql(f"DROP TABLE {self.name(layer, table)}")
        self.create(layer, table, columns, place=place)
        return self.read(layer, table)

    def write_bucketed(self, df: DataFrame, columns: Sequence[Column], key: str, buckets: int, layer: str, table: str) -> tuple[str, str]:
        """Write ``df``, which is grouped by ``key``, in ``buckets`` files by it; returns the folder and a table over it, to be dropped by ``forget``."""
        place, name = self.new_folder(layer, table, "keys"), f"{self.database(layer)}.`_new_{uuid.uuid4().hex}`"
        self.spark.sql(
            f"CREATE TABLE {name} ({_ddl(columns)}) USING parquet OPTIONS (compression '{CODEC}') CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{sql_str(place)}'"
        )
        rows = df.select(*[c.name for c in columns])
        if int(self.spark.conf.get("spark.sql.shuffle.partitions")) != buckets:  # else the grouping has dealt them out as the buckets ask
            rows = rows.repartition(buckets, key)
        rows.write.insertInto(name)
        return place, name

    def drop(self, layer: str, table: str) -> None:
        """Remove a table and all its folders, for a warehouse that goes; the journal still names them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")
        files.delete(self.spark, table_path(self.warehouse, layer, table))

    def remove(self, layers: Sequence[str]) -> None:
        """Remove the whole warehouse, and the databases of its layers from the catalog."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")
        files.delete(self.spark, self.warehouse)

    def forget(self, name: str) -> None:
        """Drop a name; the files stay (the table has a location of its own)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # ── journal ──────────────────────────────────────────────────────────────

    def _note(self, entries: list[dict]) -> None:
        text = "".join(json.dumps(e) + "\n" for e in entries)
        folder = os.path.join(self.warehouse, JOURNAL)
        files.write_text(self.spark, os.path.join(folder, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"), text)

    def note_compaction(self, table: str, last: tuple[int, str]) -> None:
        self._note([{"layer": "bronze", "table": table, COMPACTED: list(last)}])

    def journal(self) -> list[dict]:
        """All notes in order (one per table definition and commit: as many as loads)."""
        folder = os.path.join(self.warehouse, JOURNAL)
        return [json.loads(line) for name in files.names(self.spark, folder) if name.endswith(".json") for line in files.read_text(self.spark, os.path.join(folder, name)).splitlines()]

    def _attach(self, layer: str, table: str) -> bool:
        """Define a table in this session's catalog as the journal's last state has it; False if it has none."""
        made, places = None, {}
        for e in self.journal():
            if (e["layer"], e["table"]) != (layer, table):
                continue
            if "columns" in e and not e.get("added"):
                made, places = e | {"columns": list(e["columns"])}, {}
            elif "columns" in e:
                made["columns"] += e["columns"]
            elif "location" in e:
                places[tuple(e["load"]) if e["load"] else None] = e["location"]
        if made is None:
            return False
        self._define(made | {"place": places.get(None) or made["place"]})
        for key, location in places.items():
            if key is not None and location is not None:
                self._switch(Change(layer, table, location, key))
        return True

    def vacuum(self, layer: str, table: str) -> int:
        """Remove the folders of attempts that no location names (no reader of an older state may be running); returns how many."""
        if not self.exists(layer, table):
            return 0
        named = {self.location(layer, table, x) for x in (self.loads(layer, table) if self.is_partitioned(layer, table) else [None])}
        named, root = {files.qualified(self.spark, x) for x in named if x}, table_path(self.warehouse, layer, table)
        named |= {os.path.dirname(x) for x in named}  # a folder of buckets stays while one of them is named
        old = [x for x in files.names(self.spark, root) if files.qualified(self.spark, os.path.join(root, x)) not in named]
        for x in old:
            files.delete(self.spark, os.path.join(root, x))
        return len(old)
