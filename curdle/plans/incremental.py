"""Silver models kept up by key: only the keys that changed loads touch are built anew.

A model remembers the bronze folders it was built from (a note of its last commit). What the
catalog names now and what it named then tell which loads have come, gone or been loaded again;
their rows, old and new, hold every key whose newest row may differ.

* If all changed loads stand after those the model knows, their newest rows win as they are:
  nothing else of bronze is read.
* Else the touched keys are built from all their bronze rows, found by a semi join.

The model is stored in buckets of its key, and only buckets with a touched key are written, to a
new folder that the catalog is then switched to. The result equals a full build. A model without
such a note, or whose old folders are gone (``vacuum``), is built in full.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.operators.dedup import DUP
from curdle.operators.materialize import discard, stage
from curdle.plans.ingest import BRONZE, load_place
from curdle.plans.silver import KEY, SILVER_MODELS, raw_key
from curdle.sources import files
from curdle.sources import store as st
from curdle.sources.store import BUCKET, FILE, RUN, Change, Store

APPLIED = "applied"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _applied(store: Store, layer: str, model: str) -> dict | None:
    """The note of the model's last commit: bronze folder of each load, and the number of buckets."""
    notes = [e for e in store.journal() if (e["layer"], e["table"]) == (layer, model)]
    return notes[-1] if notes and APPLIED in notes[-1] else None


def _of_loads(loads) -> Column:
    out = F.lit(False)
    for run, file in loads:
        out = out | ((F.col(RUN) == run) & (F.col(FILE) == file))
    return out


def update_model(spark: SparkSession, warehouse: str, model: str, layer: str = "silver", strict: bool = True, buckets: int | None = None) -> str:
    """Bring one model up to date; returns "full", "later loads", "touched keys" or "unchanged"."""
    store = Store(spark, warehouse)
    table, build = SILVER_MODELS[model]
    loads = store.loads(BRONZE, table)
    now = {x: store.location(BRONZE, table, x) for x in loads}
    bronze = store.read(BRONZE, table)
    note = _applied(store, layer, model) if store.exists(layer, model) and store.is_partitioned(layer, model) else None
    was = {(run, file): place for run, file, place in note[APPLIED]} if note else {}
    changed = {x for x in now.keys() | was.keys() if now.get(x) != was.get(x)}
    old = [was[x] for x in changed if x in was]
    if note is None or not all(files.exists(spark, x) for x in old):
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        return _replace(store, layer, model, build(bronze, strict=strict, keyed=True), list(range(buckets)), buckets, now, "full")
    if not changed:
        return "unchanged"
    buckets = note["buckets"]
    later = not old and min(load_place(x, table) for x in changed) > max((load_place(x, table) for x in was), default=(-1, -1))
    mine = bronze.where(_of_loads(changed))
    if later:
        rows = mine.where(~F.col(DUP))
        keys = rows.select(raw_key(model).alias(KEY)).distinct()
    else:
        keys = mine.select(raw_key(model).alias(KEY))
        if old:
            fields = [f for f in bronze.schema.fields if f.name not in (RUN, FILE)]
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            keys = keys.unionByName(spark.read.schema(schema).parquet(*old).select(raw_key(model).alias(KEY)))
        keys = keys.distinct()
        rows = None
    touched, path = stage(keys.withColumn(BUCKET, _bucket(F.col(KEY), buckets)), f"touched-{model}")
    try:
        if rows is None:
            at = bronze.withColumn(KEY, raw_key(model))
            rows = at.join(touched.select(F.col(KEY).alias("_touched")), F.col(KEY).eqNullSafe(F.col("_touched")), "left_semi").drop(KEY)
        places = sorted(r[BUCKET] for r in touched.select(BUCKET).distinct().collect())  # as many as buckets
        kept = store.read(layer, model).where(F.col(BUCKET).isin(places)).drop(BUCKET).alias("m")
        kept = kept.join(touched.alias("t"), F.col(f"m.{KEY}").eqNullSafe(F.col(f"t.{KEY}")), "left_anti")
        new = build(rows, strict=strict, keyed=True)
        return _replace(store, layer, model, kept.unionByName(new), places, buckets, now, "later loads" if later else "touched keys")
    finally:
        discard(spark, path)


def _replace(store: Store, layer: str, model: str, rows: DataFrame, places: list[int], buckets: int, now: dict, how: str) -> str:
    """Write the rows of some buckets to a new folder and switch the catalog to them."""
    place = store.new_folder(layer, model)
    columns = [st.Column(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    if how == "full":
        if store.exists(layer, model):
            store.spark.sql(f"DROP TABLE {store.name(layer, model)}")
        store.create(layer, model, columns, parts="bucket")
    rows.withColumn(BUCKET, _bucket(F.col(KEY), buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(place)
    have = set(files.names(store.spark, place))
    changes = [Change(layer, model, os.path.join(place, f"{BUCKET}={b}") if f"{BUCKET}={b}" in have else None, (b,)) for b in places]
    if how == "full":
        changes = [c for c in changes if c.location]
    note = {"layer": layer, "table": model, APPLIED: [[run, file, where] for (run, file), where in now.items()], "buckets": buckets}
    store.commit(changes, note)
    return how
