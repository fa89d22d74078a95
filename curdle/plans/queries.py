"""Registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads the given test tables through the fixture derivations and
runs over whole tables. Outputs drop load-time metadata and render DECIMALs as
DOUBLE so they can be compared with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.functions.numeric import as_doubles
from curdle.operators import quality
from curdle.plans import gold
from curdle.plans.concurrency import run_all
from curdle.plans.quality_rules import RULES
from curdle.plans.bronze import fixture_firsts
from curdle.plans.silver import KEY_COLUMNS, SILVER_MODELS, comparable

Query = Callable[[SparkSession, str], DataFrame]


def silver(spark: SparkSession, sf_dir: str, model: str, narrow: bool = False) -> DataFrame:
    """A model of the fixture loads, from the rows that no earlier one equals (``b05`` has them all, flagged)."""
    table, build = SILVER_MODELS[model]
    return build(fixture_firsts(spark, sf_dir, table), narrow=narrow)


def _silver_query(model: str) -> Query:
    return lambda spark, sf_dir: comparable(silver(spark, sf_dir, model))


SILVER_QUERIES: dict[str, Query] = {
    "s01_cooperados": _silver_query("stg_cooperados"),
    "s02_fazendas": _silver_query("stg_fazendas"),
    "s03_coletas": _silver_query("stg_coletas"),
    "s04_produtos": _silver_query("stg_produtos"),
    "s05_producao": _silver_query("stg_producao"),
    "s06_clientes": _silver_query("stg_clientes"),
    "s07_pedidos": _silver_query("stg_pedidos"),
    "s08_itens_pedido": _silver_query("stg_itens_pedido"),
    "s09_rotas": _silver_query("stg_rotas"),
    "s10_entregas": _silver_query("stg_entregas"),
    "s11_custos": _silver_query("stg_custos"),
    "s12_perdas": _silver_query("stg_perdas"),
}


def silvers(spark: SparkSession, sf_dir: str, *models: str) -> list[DataFrame]:
    """Several silver models; their bronze loads are staged concurrently."""
    built = run_all((m, lambda m=m: silver(spark, sf_dir, m)) for m in models)
    return [built[m] for m in models]


def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.numbered(gold.mart_coleta_fazenda_mensal(*silvers(spark, sf_dir, "stg_coletas", "stg_fazendas", "stg_cooperados")), "mart_coleta_fazenda_mensal")


def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.numbered(gold.mart_eficiencia_producao(*silvers(spark, sf_dir, "stg_producao", "stg_produtos")), "mart_eficiencia_producao")


def g03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.numbered(gold.mart_logistica_sla(*silvers(spark, sf_dir, "stg_entregas", "stg_rotas")), "mart_logistica_sla")


def g04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.numbered(gold.mart_perdas_consolidado(silver(spark, sf_dir, "stg_perdas"), grain="day"), "mart_perdas_consolidado")


def g04b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.mart_perdas_consolidado(silver(spark, sf_dir, "stg_perdas"), grain="month")


def g05(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = gold.mart_resultado_mensal(*silvers(spark, sf_dir, "stg_pedidos", "stg_itens_pedido", "stg_custos", "stg_perdas", "stg_entregas"))
    return gold.numbered(mart, "mart_resultado_mensal")


def g05a(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = gold.receita_mensal(*silvers(spark, sf_dir, "stg_pedidos", "stg_itens_pedido"))
    return gold.rounded_parts(r)


def g05b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rounded_parts(gold.custos_mensais(silver(spark, sf_dir, "stg_custos")))


def g05c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rounded_parts(gold.perdas_mensais(silver(spark, sf_dir, "stg_perdas")))


def g05d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rounded_parts(gold.frete_mensal(silver(spark, sf_dir, "stg_entregas")))


GOLD_QUERIES: dict[str, Query] = {
    "g01_coleta_fazenda_mensal": g01,
    "g02_eficiencia_producao": g02,
    "g03_logistica_sla": g03,
    "g04_perdas_consolidado": g04,
    "g04b_perdas_month_grain": g04b,
    "g05_resultado_mensal": g05,
    "g05a_receita": g05a,
    "g05b_custos": g05b,
    "g05c_perdas": g05c,
    "g05d_frete": g05d,
}




# ── quality ──────────────────────────────────────────────────────────────────


#: Columns beside its key up to which a model's newest rows are picked column by column (a collection field is three in bronze).
FEW = 2


def silver_for(spark: SparkSession, sf_dir: str, rules: list[quality.Rule]) -> dict[str, DataFrame]:
    """The models that ``rules`` need; the suite runs each once, and reads only the columns that rules name."""
    asked: dict[str, set[str]] = {}
    for r in rules:
        asked.setdefault(r.model, set()).add(r.column)
        if r.parent:
            asked.setdefault(r.parent, set()).add(r.parent_column)
    narrow = {m: len(columns - set(KEY_COLUMNS[m])) * len(KEY_COLUMNS[m]) <= FEW for m, columns in asked.items()}
    return {m: silver(spark, sf_dir, m, narrow[m]) for m in asked}


def _suite_for(tests: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = [r for r in RULES if r.test in tests]
        return quality.run_suite(silver_for(spark, sf_dir, rules), rules)

    return run


def q03_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value outside its accepted list, with its row count (each model is read once, so none is written)."""
    rules = [r for r in RULES if r.test == "accepted_values"]
    models = dict(zip((r.model for r in rules), silvers(spark, sf_dir, *(r.model for r in rules))))
    parts = []
    for r in rules:
        bad = quality.accepted_values_failures(models[r.model], r.column, r.values)
        parts.append(
            bad.select(
                F.lit(r.model).alias("model"),
                F.lit(r.column).alias("column_name"),
                F.col(r.column).cast("string").alias("value"),
                F.col("n_records"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUALITY_QUERIES: dict[str, Query] = {
    "q01_not_null": _suite_for(("not_null",)),
    "q02_unique": _suite_for(("unique",)),
    "q03_accepted_values": q03_accepted_values,
    "q04_relationships": _suite_for(("relationships",)),
    "q05_suite_summary": _suite_for(("not_null", "unique", "accepted_values", "relationships")),
}


def all_queries() -> dict[str, Query]:
    from curdle.plans.bronze_queries import BRONZE_QUERIES
    from curdle.plans.operator_queries import OPERATOR_QUERIES

    out: dict[str, Query] = {}
    out.update(BRONZE_QUERIES)
    out.update(SILVER_QUERIES)
    out.update({name: _in_doubles(q) for name, q in GOLD_QUERIES.items()})
    out.update(QUALITY_QUERIES)
    out.update({name: _in_doubles(q) for name, q in OPERATOR_QUERIES.items()})
    return out


def _in_doubles(query: Query) -> Query:
    return lambda spark, sf_dir: as_doubles(query(spark, sf_dir))
