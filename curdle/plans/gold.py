"""Gold marts: monthly aggregates over the silver models.

Plan shape used throughout: aggregate the fact to the finest grain the
dimensions need (month × dimension key), join the dimensions to that small
result, then finish the aggregate on the mart's grain. Counts, sums and maxima
recombine exactly, so the result equals "join every fact row, then group", but
the join sees months × keys rows instead of the whole fact table and no fact
row is shuffled for the join.

Output measures are DECIMAL: exact sums rounded half-up, and averages/ratios
computed from exact sums and rounded through DECIMAL(38,10) (see
functions.numeric).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curdle.functions.dates import month_start
from curdle.functions.numeric import NUMERIC, ratio, round_decimal, round_ratio
from curdle.operators.aggregates import count_when, reaggregate, share_of_period, sum_when
from curdle.operators.ordering import with_row_number


def _avg(sum_col: str, count_col: str) -> Column:
    return ratio(F.col(sum_col), F.col(count_col))


def _sum_count(c: Column, name: str) -> list[Column]:
    """Partial pieces of an average: exact sum and non-null count."""
    return [F.sum(c).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n")]


#: The order of each mart: column and whether it descends (nulls last where ascending, first where descending).
MART_ORDER: dict[str, tuple[tuple[str, bool], ...]] = {
    "mart_coleta_fazenda_mensal": (("mes", False), ("volume_total_litros", True)),
    "mart_eficiencia_producao": (("mes", False), ("rendimento_medio_pct", True)),
    "mart_logistica_sla": (("mes", False), ("pct_no_prazo", False)),
    "mart_perdas_consolidado": (("mes", False), ("valor_perdido", True)),
    "mart_resultado_mensal": (("mes", False),),
}


def mart_order(mart: str) -> list[Column]:
    return [F.col(c).desc_nulls_first() if down else F.col(c).asc_nulls_last() for c, down in MART_ORDER[mart]]


def numbered(df: DataFrame, mart: str) -> DataFrame:
    """The mart with ``row_no``, its place in the mart's order; ties go by the other columns, nulls first."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in dict(MART_ORDER[mart])]
    return with_row_number(df, [*mart_order(mart), *rest])


# ── g01 ─────────────────────────────────────────────────────────────────────


def mart_coleta_fazenda_mensal(coletas: DataFrame, fazendas: DataFrame, cooperados: DataFrame) -> DataFrame:
    """Monthly collection quality per farm (all collections with a parsed date, valid or not)."""
    per_farm = (
        coletas.where(F.col("data_coleta").isNotNull())
        .groupBy(month_start(F.col("data_coleta")).alias("mes"), "id_fazenda")
        .agg(
            F.count(F.lit(1)).alias("qtd_coletas"),
            *_sum_count(F.col("volume_litros"), "vol"),
            *_sum_count(F.col("gordura_pct"), "fat"),
            *_sum_count(F.col("proteina_pct"), "prot"),
            *_sum_count(F.col("acidez"), "acid"),
            *_sum_count(F.col("temperatura_c"), "temp"),
            F.sum(F.when(F.col("_dq_ok"), 1).otherwise(0)).cast("bigint").alias("validas"),
        )
    )
    farms = fazendas.select("id_fazenda", "nome_fazenda", "municipio", "id_cooperado")
    members = cooperados.select("id_cooperado", F.col("nome").alias("nome_cooperado"))
    joined = per_farm.join(farms, "id_fazenda", "left").join(members, "id_cooperado", "left")
    partials = [c for c in per_farm.columns if c not in ("mes", "id_fazenda")]
    grouped = reaggregate(joined, ["mes", "id_fazenda", "nome_fazenda", "municipio", "nome_cooperado"], partials)
    return grouped.select(
        "mes",
        "id_fazenda",
        "nome_fazenda",
        "municipio",
        "nome_cooperado",
        "qtd_coletas",
        round_decimal(F.col("vol_sum"), 0).alias("volume_total_litros"),
        round_ratio(_avg("vol_sum", "vol_n"), 1).alias("volume_medio_por_coleta"),
        round_ratio(_avg("fat_sum", "fat_n"), 3).alias("gordura_media_pct"),
        round_ratio(_avg("prot_sum", "prot_n"), 3).alias("proteina_media_pct"),
        round_ratio(_avg("acid_sum", "acid_n"), 2).alias("acidez_media"),
        round_ratio(_avg("temp_sum", "temp_n"), 1).alias("temperatura_media_c"),
        round_ratio(ratio(F.col("validas"), F.col("qtd_coletas")) * 100, 1).alias("pct_coletas_validas"),
    ).orderBy(*mart_order("mart_coleta_fazenda_mensal"))


# ── g02 ─────────────────────────────────────────────────────────────────────


def mart_eficiencia_producao(producao: DataFrame, produtos: DataFrame) -> DataFrame:
    """Monthly production efficiency per line and product (valid orders only)."""
    vin, vout = F.col("volume_entrada_litros"), F.col("volume_saida")
    # Few orders share a month, line and product: the fact is joined as it is (the product
    # table is broadcast where it is small) and aggregated once.
    products = produtos.select("id_produto", F.col("categoria").alias("categoria_produto"), "nome_produto")
    joined = producao.where(F.col("_dq_ok")).join(products, "id_produto", "left")
    keys = [month_start(F.col("data_producao")).alias("mes"), "linha_producao", "categoria_produto", "nome_produto"]
    grouped = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("qtd_ordens"),
        F.sum(vin).alias("in_sum"),
        F.sum(vout).alias("out_sum"),
        *_sum_count(F.col("rendimento_pct"), "yield"),
        F.sum(vin - vout).alias("loss_sum"),
        F.sum("custo_total").alias("cost_sum"),
    )
    return grouped.select(
        "mes",
        "linha_producao",
        "categoria_produto",
        "nome_produto",
        "qtd_ordens",
        round_decimal(F.col("in_sum"), 0).alias("total_entrada_litros"),
        round_decimal(F.col("out_sum"), 0).alias("total_saida"),
        round_ratio(_avg("yield_sum", "yield_n") * 100, 2).alias("rendimento_medio_pct"),
        round_decimal(F.col("loss_sum"), 0).alias("perda_processo_litros"),
        round_ratio(ratio(F.col("loss_sum"), F.col("in_sum")) * 100, 2).alias("pct_perda_processo"),
        round_decimal(F.col("cost_sum"), 2).alias("custo_total"),
        round_ratio(ratio(F.col("cost_sum"), F.col("out_sum")), 4).alias("custo_por_unidade_saida"),
    ).orderBy(*mart_order("mart_eficiencia_producao"))


# ── g03 ─────────────────────────────────────────────────────────────────────


def mart_logistica_sla(entregas: DataFrame, rotas: DataFrame) -> DataFrame:
    """Monthly delivery SLA per route, by planned month. A missing delay counts as on time."""
    status, delay = F.col("status_entrega"), F.col("dias_atraso")
    per_route = (
        entregas.where(F.col("_dq_ok") & F.col("data_prevista").isNotNull())
        .groupBy(month_start(F.col("data_prevista")).alias("mes"), "id_rota")
        .agg(
            F.count(F.lit(1)).alias("qtd_entregas"),
            count_when(status == "ENTREGUE").alias("qtd_entregues"),
            count_when(status == "DEVOLVIDO").alias("qtd_devolvidas"),
            count_when(status == "PENDENTE").alias("qtd_pendentes"),
            count_when(F.coalesce(delay, F.lit(0)) <= 0).alias("qtd_no_prazo"),
            *_sum_count(delay, "delay"),
            F.max(delay).alias("atraso_maximo_dias"),
            *_sum_count(F.col("custo_frete"), "freight"),
            *_sum_count(F.col("km_percorrido"), "km"),
        )
    )
    routes = rotas.select("id_rota", "nome_rota", "municipio_origem", "veiculo_tipo")
    joined = per_route.join(routes, "id_rota", "left")
    partials = [c for c in per_route.columns if c not in ("mes", "id_rota", "atraso_maximo_dias")]
    grouped = reaggregate(
        joined, ["mes", "id_rota", "nome_rota", "municipio_origem", "veiculo_tipo"], partials, ["atraso_maximo_dias"]
    )
    return grouped.select(
        "mes",
        "id_rota",
        "nome_rota",
        "municipio_origem",
        "veiculo_tipo",
        "qtd_entregas",
        "qtd_entregues",
        "qtd_devolvidas",
        "qtd_pendentes",
        "qtd_no_prazo",
        round_ratio(ratio(F.col("qtd_no_prazo"), F.col("qtd_entregas")) * 100, 1).alias("pct_no_prazo"),
        round_ratio(_avg("delay_sum", "delay_n"), 1).alias("atraso_medio_dias"),
        "atraso_maximo_dias",
        round_decimal(F.col("freight_sum"), 2).alias("custo_frete_total"),
        round_ratio(_avg("freight_sum", "freight_n"), 2).alias("custo_frete_medio"),
        round_ratio(_avg("km_sum", "km_n"), 1).alias("km_medio"),
        round_ratio(ratio(F.col("freight_sum"), F.col("km_sum")), 4).alias("custo_por_km"),
    ).orderBy(*mart_order("mart_logistica_sla"))


# ── g04 ─────────────────────────────────────────────────────────────────────


def mart_perdas_consolidado(perdas: DataFrame, grain: str = "day") -> DataFrame:
    """Losses per month, stage and type, with each group's share of the month's value.

    ``grain="day"`` groups by the loss date as well without projecting it (one
    row per month × stage × type × day, as the reference mart does);
    ``grain="month"`` gives one row per month × stage × type.
    """
    keys = [month_start(F.col("data_perda")).alias("mes"), "etapa", "tipo_perda"]
    if grain == "day":
        keys.append("data_perda")
    elif grain != "month":
        raise ValueError(f"grain must be 'day' or 'month', not {grain!r}")
    grouped = (
        perdas.where(F.col("_dq_ok") & F.col("data_perda").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("qtd_ocorrencias"),
            F.sum("volume_litros_ou_kg").alias("vol_sum"),
            *_sum_count(F.col("valor_estimado"), "value"),
        )
    )
    with_total = share_of_period(grouped, "value_sum", "mes", "month_value")
    return with_total.select(
        "mes",
        "etapa",
        "tipo_perda",
        "qtd_ocorrencias",
        round_decimal(F.col("vol_sum"), 1).alias("volume_perdido"),
        round_decimal(F.col("value_sum"), 2).alias("valor_perdido"),
        round_ratio(_avg("value_sum", "value_n"), 2).alias("valor_medio_por_ocorrencia"),
        round_ratio(ratio(F.col("value_sum"), F.col("month_value")) * 100, 2).alias("pct_valor_no_mes"),
    ).orderBy(*mart_order("mart_perdas_consolidado"))


# ── g05 and its four inputs ──────────────────────────────────────────────────

# Cost types and cost centres reported in the monthly result.
COST_TYPES = {"custo_fixo": "FIXO", "custo_variavel": "VARIÁVEL"}
COST_CENTRES = {
    "custo_producao": "Produção",
    "custo_coleta": "Coleta",
    "custo_logistica": "Logística",
    "custo_comercial": "Comercial",
    "custo_administrativo": "Administrativo",
}


# With a percentage of DECIMAL(18,4) the product has 38 digits, so Spark keeps all its decimals.
_ORDER_TOTAL = "decimal(19,4)"


def receita_mensal(pedidos: DataFrame, itens: DataFrame) -> DataFrame:
    """Monthly revenue of valid, non-cancelled orders (exact DECIMAL sums).

    Items are summed per order before the join, so the join sees one row per order.
    The discount is summed as total × percent, exact to eight decimals, and divided by
    100 once, in the month's sum.
    """
    per_order = itens.where(F.col("_dq_ok")).groupBy("id_pedido").agg(F.sum("valor_total").cast(_ORDER_TOTAL).alias("order_total"))
    orders = pedidos.where(F.col("_dq_ok") & (F.col("status") != "CANCELADO")).select(
        "id_pedido", "data_pedido", "desconto_pct"
    )
    joined = orders.join(per_order, "id_pedido", "inner")
    hundredfold = F.sum(F.col("order_total") * F.coalesce(F.col("desconto_pct"), F.lit(0).cast(NUMERIC)))
    gross, discount = F.sum("order_total").cast("decimal(24,4)"), hundredfold.cast("decimal(30,8)") * F.lit("0.01").cast("decimal(2,2)")
    return joined.groupBy(month_start(F.col("data_pedido")).alias("mes")).agg(
        gross.alias("receita_bruta"),
        discount.alias("desconto_total"),
        (gross - discount).alias("receita_liquida"),
        F.count_distinct("id_pedido").alias("qtd_pedidos"),
    )


def custos_mensais(custos: DataFrame) -> DataFrame:
    """Monthly costs by type and centre (one pass, conditional sums)."""
    value = F.col("valor")
    by_type = [sum_when(F.col("tipo_custo") == t, value).alias(n) for n, t in COST_TYPES.items()]
    by_centre = [sum_when(F.col("centro_custo") == c, value).alias(n) for n, c in COST_CENTRES.items()]
    return (
        custos.where(F.col("_dq_ok"))
        .groupBy(month_start(F.col("data_referencia")).alias("mes"))
        .agg(*by_type, F.sum(value).alias("custo_total"), *by_centre)
    )


def perdas_mensais(perdas: DataFrame) -> DataFrame:
    return (
        perdas.where(F.col("_dq_ok"))
        .groupBy(month_start(F.col("data_perda")).alias("mes"))
        .agg(F.sum("valor_estimado").alias("valor_perdas"))
    )


def frete_mensal(entregas: DataFrame) -> DataFrame:
    """Freight by the month the delivery actually happened."""
    return (
        entregas.where(F.col("_dq_ok") & F.col("data_realizada").isNotNull())
        .groupBy(month_start(F.col("data_realizada")).alias("mes"))
        .agg(F.sum("custo_frete").alias("custo_frete_total"))
    )


def mart_resultado_mensal(
    pedidos: DataFrame, itens: DataFrame, custos: DataFrame, perdas: DataFrame, entregas: DataFrame
) -> DataFrame:
    """Monthly profit and loss; months without revenue do not appear."""
    r = receita_mensal(pedidos, itens)
    joined = (
        r.join(custos_mensais(custos), "mes", "left")
        .join(perdas_mensais(perdas), "mes", "left")
        .join(frete_mensal(entregas), "mes", "left")
    )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    result = (
        F.col("receita_liquida") - zero("custo_total") - zero("custo_frete_total") - zero("valor_perdas")
    )
    cost_cols = [*COST_TYPES, *COST_CENTRES]
    return joined.select(
        "mes",
        round_decimal(F.col("receita_bruta"), 2).alias("receita_bruta"),
        round_decimal(F.col("desconto_total"), 2).alias("desconto_total"),
        round_decimal(F.col("receita_liquida"), 2).alias("receita_liquida"),
        "qtd_pedidos",
        *[round_decimal(zero(c), 2).alias(c) for c in cost_cols],
        round_decimal(zero("custo_frete_total"), 2).alias("custo_frete"),
        round_decimal(zero("valor_perdas"), 2).alias("valor_perdas"),
        round_decimal(result, 2).alias("resultado_estimado"),
        round_ratio(ratio(result, F.col("receita_liquida")) * 100, 2).alias("margem_pct"),
    ).orderBy(*mart_order("mart_resultado_mensal"))


def rounded_parts(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every DECIMAL column of a CTE-level result (for reporting and checks)."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        cols.append(round_decimal(c, digits).alias(field.name) if field.dataType.typeName() == "decimal" else c)
    return df.select(*cols)
