"""Single-operator queries: each exercises one operator over whole fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curdle.functions.dates import month_start
from curdle.functions.numeric import as_double, ratio, round_decimal, round_ratio
from curdle.functions.text import collapse_first_whitespace_run, upper_trim, yes_no_flag
from curdle.operators.aggregates import share_of_period, sum_when
from curdle.plans.bronze import fixture_firsts
from curdle.plans.silver import latest_rows, stg_coletas, stg_custos, stg_entregas, stg_fazendas, stg_itens_pedido
from curdle.plans.silver import stg_pedidos, stg_perdas

Query = Callable[[SparkSession, str], DataFrame]


def o01_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of each order (run 2 re-sends and changes some)."""
    rows = latest_rows(fixture_firsts(spark, sf_dir, "pedidos"), "id_pedido")
    return rows.select("id_pedido", "status", "_batch_id", "_row_hash")


def o02_left_join_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each collection with its farm's attributes (unknown farms keep nulls)."""
    c = stg_coletas(fixture_firsts(spark, sf_dir, "coletas")).select("id_coleta", "id_fazenda")
    f = stg_fazendas(fixture_firsts(spark, sf_dir, "fazendas")).select(
        "id_fazenda", "nome_fazenda", "municipio", "id_cooperado"
    )
    return c.join(f, "id_fazenda", "left")


def o03_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid items of valid, non-cancelled orders."""
    p = stg_pedidos(fixture_firsts(spark, sf_dir, "pedidos"))
    i = stg_itens_pedido(fixture_firsts(spark, sf_dir, "itens_pedido"))
    orders = p.where(F.col("_dq_ok") & (F.col("status") != "CANCELADO")).select("id_pedido", "data_pedido", "desconto_pct")
    items = i.where(F.col("_dq_ok")).select("id_pedido", "id_item", "valor_total")
    joined = orders.join(items, "id_pedido", "inner")
    return joined.select(
        "id_pedido", "id_item", "data_pedido", as_double(F.col("valor_total")).alias("valor_total"),
        as_double(F.col("desconto_pct")).alias("desconto_pct"),
    )


def o04_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers and orders per order month."""
    p = stg_pedidos(fixture_firsts(spark, sf_dir, "pedidos"))
    return p.groupBy(month_start(F.col("data_pedido")).alias("mes")).agg(
        F.count_distinct("id_cliente").alias("qtd_clientes"), F.count(F.lit(1)).alias("qtd_pedidos")
    )


def o05_conditional_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed vs variable cost per accounting period, in one pass."""
    c = stg_custos(fixture_firsts(spark, sf_dir, "custos_operacionais")).where(F.col("_dq_ok"))
    agg = c.groupBy("competencia").agg(
        sum_when(F.col("tipo_custo") == "FIXO", F.col("valor")).alias("custo_fixo"),
        sum_when(F.col("tipo_custo") == "VARIÁVEL", F.col("valor")).alias("custo_variavel"),
        F.sum("valor").alias("custo_total"),
    )
    return agg.select(
        "competencia", *[round_decimal(F.col(n), 2).alias(n) for n in ("custo_fixo", "custo_variavel", "custo_total")]
    )


def o06_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freight per km by route; a zero or missing distance gives null, not an error."""
    e = stg_entregas(fixture_firsts(spark, sf_dir, "entregas")).where(F.col("_dq_ok"))
    agg = e.groupBy("id_rota").agg(F.sum("custo_frete").alias("f"), F.sum("km_percorrido").alias("k"))
    return agg.select("id_rota", round_ratio(ratio(F.col("f"), F.col("k")), 4).alias("custo_por_km"))


def o07_share_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's share of the month's loss value."""
    p = stg_perdas(fixture_firsts(spark, sf_dir, "perdas")).where(F.col("_dq_ok") & F.col("data_perda").isNotNull())
    agg = p.groupBy(month_start(F.col("data_perda")).alias("mes"), "etapa").agg(F.sum("valor_estimado").alias("v"))
    shared = share_of_period(agg, "v", "mes", "month_v")
    return shared.select(
        "mes", "etapa", round_decimal(F.col("v"), 2).alias("valor_perdido"),
        round_ratio(ratio(F.col("v"), F.col("month_v")) * 100, 2).alias("pct_valor_no_mes"),
    )


def o08_month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = stg_coletas(fixture_firsts(spark, sf_dir, "coletas")).where(F.col("data_coleta").isNotNull())
    return c.groupBy(month_start(F.col("data_coleta")).alias("mes")).agg(F.count(F.lit(1)).alias("qtd_coletas"))


def o09_sla_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = stg_entregas(fixture_firsts(spark, sf_dir, "entregas"))
    return e.select("id_entrega", "data_prevista", "data_realizada", "dias_atraso")


def o10_text_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yes/no text → boolean, for customers and routes."""
    cli = latest_rows(fixture_firsts(spark, sf_dir, "clientes"), "id_cliente").select(
        F.lit("clientes").alias("source"), F.col("id_cliente").alias("record_key"), F.col("ativo").alias("raw_value")
    )
    rot = latest_rows(fixture_firsts(spark, sf_dir, "rotas"), "id_rota").select(
        F.lit("rotas").alias("source"), F.col("id_rota").alias("record_key"), F.col("ativa").alias("raw_value")
    )
    both = cli.unionByName(rot)
    return both.withColumn("ativo", yes_no_flag(F.col("raw_value")))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_itens_pedido(fixture_firsts(spark, sf_dir, "itens_pedido"))


def o11_impute_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _items(spark, sf_dir)
    return i.select(
        "id_item", "quantidade", as_double(F.col("preco_unitario")).alias("preco_unitario"),
        as_double(F.col("valor_total_raw")).alias("valor_total_raw"), as_double(F.col("valor_total")).alias("valor_total"),
        "_dq_valor_total_imputado",
    )


def o12_abs_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _items(spark, sf_dir)
    return i.select(
        "id_item", as_double(F.col("preco_unitario_raw")).alias("preco_unitario_raw"),
        as_double(F.col("preco_unitario")).alias("preco_unitario"), "_dq_preco_negativo",
    )


def o13_regexp_replace_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production-line names: only the first whitespace run collapses."""
    rows = latest_rows(fixture_firsts(spark, sf_dir, "producao"), "id_producao")
    per_value = rows.groupBy(F.col("linha_producao").alias("linha_raw")).agg(F.count(F.lit(1)).alias("qtd"))
    return per_value.select(
        "linha_raw", upper_trim(collapse_first_whitespace_run(F.col("linha_raw"))).alias("linha_producao"), "qtd"
    )


OPERATOR_QUERIES: dict[str, Query] = {
    "o01_latest_by_key": o01_latest_by_key,
    "o02_left_join_enrich": o02_left_join_enrich,
    "o03_inner_join": o03_inner_join,
    "o04_count_distinct": o04_count_distinct,
    "o05_conditional_agg": o05_conditional_agg,
    "o06_safe_ratio": o06_safe_ratio,
    "o07_share_of_period": o07_share_of_period,
    "o08_month_bucket": o08_month_bucket,
    "o09_sla_days": o09_sla_days,
    "o10_text_flag": o10_text_flag,
    "o11_impute_total": o11_impute_total,
    "o12_abs_price": o12_abs_price,
    "o13_regexp_replace_first": o13_regexp_replace_first,
}
