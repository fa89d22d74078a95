"""Layers (bronze / silver / gold): their names, folders and listing."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")
DEFAULT_LAYER = "public"


def layer_for(custom_layer: str | None, default_layer: str = DEFAULT_LAYER) -> str:
    """A model's layer: its own configured layer verbatim, else the default one."""
    return custom_layer.strip() if custom_layer else default_layer


def qualified(layer: str, name: str) -> str:
    return f"{layer}.{name}"


def table_path(warehouse: str, layer: str, name: str) -> str:
    return os.path.join(warehouse, layer, name)


def sql_str(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def ensure_layers(spark: SparkSession, warehouse: str, layers: tuple[str, ...] = LAYERS) -> list[str]:
    """Create each layer's database, located under the warehouse folder; returns their names (see ``Store.database``)."""
    from curdle.sources.store import Store

    return [Store(spark, warehouse).database(layer) for layer in layers]


def list_tables(spark: SparkSession, layer: str) -> list[str]:
    """Tables of one layer (a database name), ordered by name; the session's temporary views are none of them."""
    return sorted(t.name for t in spark.catalog.listTables(layer) if not t.isTemporary)


def read(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(qualified(layer, name))
