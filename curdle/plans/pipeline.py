"""End-to-end runs over a warehouse folder: bronze loads, silver and gold rebuilds, quality tests.

  run_bronze(spark, raw_dir, warehouse, batch_id)  every manifest file present in raw_dir
  run_silver(spark, warehouse)                     12 models, each written once
  run_gold(spark, warehouse)                       5 marts (+ month-grain losses), rebuilt in full
  run_tests(spark, warehouse)                      the 48 declared tests → summary table

Every layer's tables lie under ``warehouse/<layer>/<name>`` and are known to the
catalog as ``<layer>.<name>``; a rebuild is written beside the old version and the
table's location switched to it, so a reader sees one whole version or the other
(``sources.store``). Consumers read the written tables, so a mart never recomputes
the silver lineage and a lost executor only costs re-reading files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curdle.operators.quality import run_suite
from curdle.plans import gold
from curdle.plans.concurrency import run_all
from curdle.plans.incremental import update_model
from curdle.plans.ingest import LOG_SCHEMA, LOG_TABLE, compact, load_file, read_bronze
from curdle.plans.quality_rules import RULES
from curdle.plans.silver import KEY, SILVER_MODELS
from curdle.sources import catalog
from curdle.sources.manifest import MANIFEST
from curdle.sources.store import BUCKET, Column, Store

#: Layer of each kind of model, and any that a project places elsewhere (model name → layer).
DEFAULT_LAYERS = {"silver": "silver", "gold": "gold"}
MODEL_LAYERS: dict[str, str] = {}


def run_bronze(spark: SparkSession, raw_dir: str, warehouse: str, batch_id: int) -> list[dict]:
    """Load every manifest file found in ``raw_dir`` as run ``batch_id``, in manifest order."""
    catalog.ensure_layers(spark, warehouse)
    rows = []
    for spec in MANIFEST:
        row = load_file(spark, raw_dir, spec, warehouse, batch_id)
        if row is not None:
            rows.append(row)
    store = Store(spark, warehouse)
    if rows and not store.exists("bronze", LOG_TABLE):
        store.create("bronze", LOG_TABLE, [Column(f.name, f.dataType.simpleString()) for f in LOG_SCHEMA.fields])
    return rows


def model_layer(kind: str, name: str) -> str:
    """Where a model is written: the layer set for it, else that of its kind."""
    return catalog.layer_for(MODEL_LAYERS.get(name), DEFAULT_LAYERS[kind])


def _write(spark: SparkSession, df: DataFrame, warehouse: str, kind: str, name: str) -> DataFrame:
    return Store(spark, warehouse).write_table(df, model_layer(kind, name), name)


def read_model(spark: SparkSession, warehouse: str, kind: str, name: str) -> DataFrame:
    """A written model's current version."""
    store, layer = Store(spark, warehouse), model_layer(kind, name)
    if not store.exists(layer, name):
        raise ValueError(f"{layer}.{name} has not been built")
    return store.read(layer, name).drop(KEY, BUCKET)


def run_silver(spark: SparkSession, warehouse: str, strict: bool = True, as_views: bool = False) -> dict[str, DataFrame]:
    """Build the 12 silver models.

    Default: each model is written once as ``silver.<model>`` and consumers read
    the files. ``as_views=True`` registers lazy temporary views instead (every
    consumer then re-runs the model's plan, as a SQL view would).
    """
    catalog.ensure_layers(spark, warehouse)
    built = {}
    for model, (table, build) in SILVER_MODELS.items():
        bronze = read_bronze(spark, warehouse, table)
        if bronze is not None:
            built[model] = build(bronze, strict=strict)
    if as_views:
        for model, df in built.items():
            df.createOrReplaceTempView(model)
        return built
    return run_all((m, lambda m=m: _write(spark, built[m], warehouse, "silver", m)) for m in built)


def update_silver(spark: SparkSession, warehouse: str, strict: bool = True) -> dict[str, str]:
    """Bring the silver models up to the loads as they stand now, by keys; returns what each took (see ``incremental``)."""
    catalog.ensure_layers(spark, warehouse)
    models = [m for m, (table, _) in SILVER_MODELS.items() if Store(spark, warehouse).exists("bronze", table)]
    return run_all((m, lambda m=m: update_model(spark, warehouse, m, model_layer("silver", m), strict)) for m in models)


def silver_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {m: read_model(spark, warehouse, "silver", m) for m in SILVER_MODELS}


def run_gold(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    s = silver_tables(spark, warehouse)
    marts = {
        "mart_coleta_fazenda_mensal": gold.mart_coleta_fazenda_mensal(
            s["stg_coletas"], s["stg_fazendas"], s["stg_cooperados"]
        ),
        "mart_eficiencia_producao": gold.mart_eficiencia_producao(s["stg_producao"], s["stg_produtos"]),
        "mart_logistica_sla": gold.mart_logistica_sla(s["stg_entregas"], s["stg_rotas"]),
        "mart_perdas_consolidado": gold.mart_perdas_consolidado(s["stg_perdas"], grain="day"),
        "mart_perdas_mensal": gold.mart_perdas_consolidado(s["stg_perdas"], grain="month"),
        "mart_resultado_mensal": gold.mart_resultado_mensal(
            s["stg_pedidos"], s["stg_itens_pedido"], s["stg_custos"], s["stg_perdas"], s["stg_entregas"]
        ),
    }
    return run_all((n, lambda n=n: _write(spark, marts[n], warehouse, "gold", n)) for n in marts)


def run_tests(spark: SparkSession, warehouse: str) -> DataFrame:
    summary = run_suite(silver_tables(spark, warehouse), RULES)
    return _write(spark, summary, warehouse, "gold", "dq_test_results")


def compact_bronze(spark: SparkSession, warehouse: str, table: str) -> int:
    """Drop a bronze table's flagged copies (see ``ingest.compact``); returns the rows removed."""
    return compact(spark, warehouse, table)
