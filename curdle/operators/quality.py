"""Declarative data-quality tests over DataFrames.

Four generic tests with the usual semantics:
  not_null(col)            failing rows: col is null                    failures = rows
  unique(col)              non-null values occurring more than once     failures = such values
  accepted_values(col, vs) values outside vs (null passes)              failures = such values
  relationships(col → parent.field)  non-null keys without a parent    failures = rows

``run_suite`` evaluates a rule list over a dict of models and returns one row
per rule. Nulls, strays and rows are observed while a model is run once; unique
and relationships rules are answered by one table of keys that parents and
children share.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from curdle.operators.materialize import discard, stage
from curdle.plans.concurrency import run_all


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: tuple[str, ...] = field(default_factory=tuple)  # accepted_values
    parent: str | None = None  # relationships: parent model
    parent_column: str | None = None  # relationships: parent key
    severity: str = "error"  # error | warn: what a failure means


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """(value, n_records) for non-null values that occur more than once (partial aggregation first)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(value, n_records) for values outside the accepted list; null passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(value, n_records) of non-null child keys without a parent row.

    Child rows are counted per key before they move (partial aggregation), so a key
    that a third of them hold weighs as much as any other.
    """
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    counts = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.join(keys, on=column, how="left_anti")


def _status(failures: int, severity: str) -> str:
    return "pass" if not failures else "warn" if severity == "warn" else "fail"


@dataclass
class _Pass:
    """What one pass over a model yields: its counts, and the narrow rows that checks between rows need."""

    counts: dict[str, int]
    path: str | None
    rows: DataFrame | None


def _observed(model: str, df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> _Pass:
    """Run a model once: nulls and strays are counted on the way, its keys and strays are written as narrow text."""
    seen = Observation()
    lists = {r.column: F.when(~F.col(r.column).isin(*r.values), F.col(r.column)).cast("string") for r in rules if r.test == "accepted_values"}
    narrow = [F.col(c).cast("string").alias(f"key {c}") for c in keys] + [v.alias(f"stray {c}") for c, v in lists.items()]
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in dict.fromkeys(r.column for r in rules if r.test == "not_null")]
    counts += [F.count(v).alias(f"strays {c}") for c, v in lists.items()]
    watched = df.observe(seen, *counts)
    if not narrow:
        watched.select(F.lit(1).alias("one")).write.format("noop").mode("overwrite").save()
        return _Pass(seen.get, None, None)
    rows, path = stage(watched.select(*narrow), f"checks-{model}")
    return _Pass(seen.get, path, rows)


def _key_checks(passes: Mapping[str, _Pass], rules: Sequence[Rule]) -> dict[Rule, int]:
    """All unique and relationships rules from one table of keys: how often each stands in its model, and in each child.

    Rows are counted per key before they move, so a key that a third of them hold weighs as much as any other.
    """
    columns = list(dict.fromkeys([(r.model, r.column) for r in rules if r.test == "unique"] + [(r.parent, r.parent_column) for r in rules if r.test == "relationships"]))
    children = {c: [r for r in rules if r.test == "relationships" and (r.parent, r.parent_column) == c] for c in columns}
    if not columns:
        return {}
    parts = []
    for i, (model, column) in enumerate(columns):
        users = [(model, column, 0)] + [(r.model, r.column, n) for n, r in enumerate(children[model, column], 1)]
        parts += [passes[m].rows.select(F.lit(i).alias("at"), F.lit(n).alias("use"), F.col(f"key {c}").alias("key")).where("key IS NOT NULL") for m, c, n in users]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    most = max(len(c) for c in children.values())
    per_key = every.groupBy("at", "key").agg(*[F.count_if(F.col("use") == n).alias(f"n{n}") for n in range(most + 1)])
    orphans = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{n}")).otherwise(0)).alias(f"orphans{n}") for n in range(1, most + 1)]
    found = {r["at"]: r for r in per_key.groupBy("at").agg(F.count_if(F.col("n0") > 1).alias("repeated"), *orphans).collect()}  # a row a key column
    out = {}
    for i, c in enumerate(columns):
        row = found.get(i)
        out |= {r: row["repeated"] if row else 0 for r in rules if r.test == "unique" and (r.model, r.column) == c}
        out |= {r: row[f"orphans{n}"] if row else 0 for n, r in enumerate(children[c], 1)}
    return out


def run_suite(models: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: model, column_name, test, failures, severity, status (pass, warn or fail).

    Each model is run once, for all its rules; nothing that only its own row decides needs a second look.
    Keys of all models are then counted in one shuffle. Only lists with strays are looked at again, to tell
    how many different ones there are.
    """
    names = list(dict.fromkeys(m for r in rules for m in (r.model, r.parent) if m))
    keyed = [r for r in rules if r.test in ("unique", "relationships")]
    keys = {m: list(dict.fromkeys([r.column for r in keyed if r.model == m] + [r.parent_column for r in keyed if r.parent == m])) for m in names}
    passes = run_all((m, lambda m=m: _observed(m, models[m], [r for r in rules if r.model == m], keys[m])) for m in names)
    spark = models[names[0]].sparkSession
    try:
        failures = _key_checks(passes, rules)
        for r in rules:
            counts = passes[r.model].counts
            if r.test == "not_null":
                failures[r] = counts[f"null {r.column}"]
            elif r.test == "accepted_values":
                failures[r] = passes[r.model].rows.select(f"stray {r.column}").where(F.col(f"stray {r.column}").isNotNull()).distinct().count() if counts[f"strays {r.column}"] else 0
    finally:
        for p in passes.values():
            if p.path:
                discard(spark, p.path)
    rows = [(r.model, r.column, r.test, failures[r], r.severity, _status(failures[r], r.severity)) for r in rules]
    return spark.createDataFrame(rows, "model string, column_name string, test string, failures long, severity string, status string")
