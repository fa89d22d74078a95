"""Silver models: bronze text → typed, cleaned, one row per natural key, with a ``_dq_ok`` flag.

Every model has the same shape:
  1. drop rows flagged as duplicates in bronze,
  2. keep the newest row per raw key: of the latest run, in it of the last file in the
     manifest, in that the last row (never by the clock: a load that is run again keeps
     its place),
  3. one ``select`` that casts and cleans.

Inside that select, the ``_dq_ok`` expressions read the *raw* bronze columns
where the model's rule is written against the input (e.g. "raw date present"),
not the cleaned output of the same name; building the model as one select
keeps the two apart. Casts are ANSI (raise on bad text) unless ``strict=False``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curdle.functions.dates import days_between, iso_date, multi_format_date
from curdle.functions.numeric import NUMERIC, as_double, ratio, round_ratio, to_bigint, to_int, to_numeric
from curdle.functions.text import blank_to_null, collapse_first_whitespace_run, sql_trim, upper_trim, yes_no_flag
from curdle.operators.dedup import DUP, latest_by_key, latest_values
from curdle.sources.manifest import MANIFEST

LINEAGE = ["_row_hash", "_source_file", "_ingested_at"]
#: The raw key of a row, carried by a model that is merged by key (``keyed=True``).
KEY = "_key"

# Accepted member statuses.
MEMBER_STATUSES = ["ATIVO", "INATIVO", "SUSPENSO"]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _place() -> Column:
    """A row's file in the order of the manifest."""
    return F.try_element_at(F.create_map(*[p for s in MANIFEST for p in (F.lit(s.file), F.lit(s.position))]), F.col("_source_file"))


def latest_rows(bronze: DataFrame, key: Column | str) -> DataFrame:
    """Steps 1–2 of every model."""
    live = bronze.where(~F.col(DUP))
    newest = latest_by_key(live, key, [F.desc("_batch_id"), _place().desc_nulls_last(), F.desc("_row_id")])
    return newest.withColumn(KEY, key if isinstance(key, Column) else _c(key))


def latest_columns(bronze: DataFrame, model: str) -> DataFrame:
    """``latest_rows`` for readers of few columns: what is not read is not derived, for the key alone not even the order."""
    newest = latest_values(bronze.where(~F.col(DUP)).withColumn(KEY, raw_key(model)), KEY, ["_batch_id", _place(), "_row_id"])
    # A model reads its key from the first of these; a row of any layout has it there.
    own, *others = KEY_COLUMNS[model]
    return newest.withColumns({own: F.col(KEY)} | {c: F.lit(None).cast("string") for c in others})


def _lineage() -> list[Column]:
    return [F.col(c) for c in [*LINEAGE, KEY]]


def _model(build: Callable[[DataFrame, bool], DataFrame]) -> Callable[..., DataFrame]:
    """A model of the newest rows, without its raw key unless ``keyed``; ``narrow`` where few of its columns are read."""

    @wraps(build)
    def run(bronze: DataFrame, strict: bool = True, keyed: bool = False, narrow: bool = False) -> DataFrame:
        model = build.__name__
        out = build(latest_columns(bronze, model) if narrow else latest_rows(bronze, raw_key(model)), strict)
        return out if keyed else out.drop(KEY)

    return run


@_model
def stg_cooperados(rows: DataFrame, strict: bool) -> DataFrame:
    typed = rows.select(
        to_bigint(_c("id_cooperado"), strict).alias("id_cooperado"),
        sql_trim(_c("nome")).alias("nome"),
        iso_date(_c("data_adesao"), strict).alias("data_adesao"),
        upper_trim(_c("situacao")).alias("situacao"),
        *_lineage(),
    )
    # This model's rule reads the typed values.
    ok = (
        F.col("id_cooperado").isNotNull()
        & F.col("nome").isNotNull()
        & F.col("data_adesao").isNotNull()
        & F.col("situacao").isin(*MEMBER_STATUSES)
    )
    return typed.withColumn("_dq_ok", ok)


@_model
def stg_fazendas(rows: DataFrame, strict: bool) -> DataFrame:
    area = to_numeric(blank_to_null(_c("area_hectares")), strict)
    animals = to_numeric(blank_to_null(_c("qtd_animais_lactacao")), strict)
    return rows.select(
        to_bigint(_c("id_fazenda"), strict).alias("id_fazenda"),
        to_bigint(_c("id_cooperado"), strict).alias("id_cooperado"),
        sql_trim(_c("nome_fazenda")).alias("nome_fazenda"),
        sql_trim(_c("municipio")).alias("municipio"),
        area.alias("area_hectares"),
        animals.alias("qtd_animais_lactacao"),
        F.trim(F.upper(_c("raca_predominante"))).alias("raca_predominante"),
        *_lineage(),
        (_c("id_fazenda").isNotNull() & _c("nome_fazenda").isNotNull() & (area > 0) & (animals > 0)).alias("_dq_ok"),
    )


# The nine collection fields and their column in each layout (A, B, C).
COLLECTION_FIELDS: dict[str, tuple[str, str, str]] = {
    "id_coleta": ("id_coleta", "collection_id", "c_coleta_id"),
    "id_fazenda": ("id_fazenda", "farm_id", "c_id_fazenda"),
    "id_rota": ("id_rota", "route_id", "c_id_rota"),
    "data_coleta": ("data_coleta", "collection_date", "c_data"),
    "volume_litros": ("volume_litros", "collected_liters", "c_volume"),
    "temperatura_c": ("temperatura_c", "temperature_c", "c_temperatura"),
    "acidez": ("acidez", "acidity", "c_acidez"),
    "gordura_pct": ("gordura_pct", "fat_pct", "c_gordura"),
    "proteina_pct": ("proteina_pct", "protein_pct", "c_proteina"),
}


def _collection_field(name: str) -> Column:
    return F.coalesce(*[_c(c) for c in COLLECTION_FIELDS[name]])


@_model
def stg_coletas(rows: DataFrame, strict: bool) -> DataFrame:
    def measure(name: str) -> Column:
        return to_numeric(F.translate(blank_to_null(_collection_field(name)), ",", "."), strict)

    typed = rows.select(
        to_bigint(_collection_field("id_coleta"), strict).alias("id_coleta"),
        to_bigint(_collection_field("id_fazenda"), strict).alias("id_fazenda"),
        to_bigint(_collection_field("id_rota"), strict).alias("id_rota"),
        multi_format_date(_collection_field("data_coleta"), strict).alias("data_coleta"),
        measure("volume_litros").alias("volume_litros_raw"),
        measure("temperatura_c").alias("temperatura_c"),
        measure("acidez").alias("acidez"),
        measure("gordura_pct").alias("gordura_pct"),
        measure("proteina_pct").alias("proteina_pct"),
        F.col("_source_format"),
        *_lineage(),
    )
    raw_volume = F.col("volume_litros_raw")
    return typed.select(
        "*",
        F.when(raw_volume < 0, F.lit(None).cast(NUMERIC)).otherwise(raw_volume).alias("volume_litros"),
        ((raw_volume > 0) & F.col("data_coleta").isNotNull() & F.col("id_fazenda").isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_produtos(rows: DataFrame, strict: bool) -> DataFrame:
    price = to_numeric(blank_to_null(_c("preco_venda")), strict)
    cost = to_numeric(_c("custo_unitario"), strict)
    return rows.select(
        to_bigint(_c("id_produto"), strict).alias("id_produto"),
        sql_trim(_c("nome_produto")).alias("nome_produto"),
        sql_trim(_c("categoria")).alias("categoria"),
        upper_trim(_c("unidade")).alias("unidade"),
        price.alias("preco_venda"),
        cost.alias("custo_unitario"),
        upper_trim(_c("ativo")).alias("ativo"),
        *_lineage(),
        (_c("id_produto").isNotNull() & _c("nome_produto").isNotNull() & (price > 0) & (cost > 0)).alias("_dq_ok"),
    )


def production_yield(volume_out: Column, volume_in: Column) -> Column:
    """``ROUND(out / NULLIF(in, 0), 4)`` as an exact 4-digit decimal."""
    return round_ratio(ratio(volume_out, volume_in), 4).cast(NUMERIC)


@_model
def stg_producao(rows: DataFrame, strict: bool) -> DataFrame:
    vin = to_numeric(_c("volume_entrada_litros"), strict)
    vout = to_numeric(_c("volume_saida"), strict)
    return rows.select(
        to_bigint(_c("id_producao"), strict).alias("id_producao"),
        to_bigint(_c("id_produto"), strict).alias("id_produto"),
        iso_date(_c("data_producao"), strict).alias("data_producao"),
        upper_trim(collapse_first_whitespace_run(_c("linha_producao"))).alias("linha_producao"),
        vin.alias("volume_entrada_litros"),
        vout.alias("volume_saida"),
        to_numeric(blank_to_null(_c("custo_total")), strict).alias("custo_total"),
        _c("lote").alias("lote"),
        iso_date(_c("validade"), strict).alias("validade"),
        production_yield(vout, vin).alias("rendimento_pct"),
        *_lineage(),
        (_c("id_producao").isNotNull() & (vin > 0)).alias("_dq_ok"),
    )


@_model
def stg_clientes(rows: DataFrame, strict: bool) -> DataFrame:
    return rows.select(
        to_bigint(_c("id_cliente"), strict).alias("id_cliente"),
        sql_trim(_c("nome_cliente")).alias("nome_cliente"),
        upper_trim(_c("segmento")).alias("segmento"),
        sql_trim(_c("estado")).alias("uf"),
        sql_trim(_c("cidade")).alias("cidade"),
        _c("cnpj").alias("documento"),
        yes_no_flag(_c("ativo")).alias("ativo"),
        *_lineage(),
        (_c("id_cliente").isNotNull() & _c("nome_cliente").isNotNull() & _c("cnpj").isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_pedidos(rows: DataFrame, strict: bool) -> DataFrame:
    return rows.select(
        to_bigint(_c("id_pedido"), strict).alias("id_pedido"),
        to_bigint(_c("id_cliente"), strict).alias("id_cliente"),
        iso_date(_c("data_pedido"), strict).alias("data_pedido"),
        upper_trim(_c("status")).alias("status"),
        upper_trim(_c("canal")).alias("canal"),
        to_numeric(blank_to_null(_c("desconto_pct")), strict).alias("desconto_pct"),
        *_lineage(),
        (_c("id_pedido").isNotNull() & _c("id_cliente").isNotNull() & _c("data_pedido").isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_itens_pedido(rows: DataFrame, strict: bool) -> DataFrame:
    typed = rows.select(
        to_bigint(_c("id_item"), strict).alias("id_item"),
        to_bigint(_c("id_pedido"), strict).alias("id_pedido"),
        to_bigint(_c("id_produto"), strict).alias("id_produto"),
        to_int(_c("quantidade"), strict).alias("quantidade"),
        to_numeric(_c("preco_unitario"), strict).alias("preco_unitario_raw"),
        to_numeric(blank_to_null(_c("valor_total")), strict).alias("valor_total_raw"),
        *_lineage(),
    )
    price, total, qty = F.col("preco_unitario_raw"), F.col("valor_total_raw"), F.col("quantidade")
    return typed.select(
        "*",
        F.abs(price).alias("preco_unitario"),
        F.coalesce(total, qty * F.abs(price)).cast(NUMERIC).alias("valor_total"),
        (price < 0).alias("_dq_preco_negativo"),
        total.isNull().alias("_dq_valor_total_imputado"),
        ((price > 0) & (qty > 0)).alias("_dq_ok"),
    )


@_model
def stg_rotas(rows: DataFrame, strict: bool) -> DataFrame:
    km = to_numeric(_c("km_total"), strict)
    return rows.select(
        to_bigint(_c("id_rota"), strict).alias("id_rota"),
        sql_trim(_c("nome_rota")).alias("nome_rota"),
        sql_trim(_c("municipio_origem")).alias("municipio_origem"),
        km.alias("km_total"),
        sql_trim(_c("veiculo_tipo")).alias("veiculo_tipo"),
        yes_no_flag(_c("ativa")).alias("ativo"),
        *_lineage(),
        (_c("id_rota").isNotNull() & km.isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_entregas(rows: DataFrame, strict: bool) -> DataFrame:
    planned = iso_date(_c("data_prevista"), strict)
    actual = iso_date(_c("data_realizada"), strict)
    return rows.select(
        to_bigint(_c("id_entrega"), strict).alias("id_entrega"),
        to_bigint(_c("id_pedido"), strict).alias("id_pedido"),
        to_bigint(_c("id_rota"), strict).alias("id_rota"),
        planned.alias("data_prevista"),
        actual.alias("data_realizada"),
        upper_trim(_c("status_entrega")).alias("status_entrega"),
        to_numeric(blank_to_null(_c("km_percorrido")), strict).alias("km_percorrido"),
        to_numeric(blank_to_null(_c("custo_frete")), strict).alias("custo_frete"),
        blank_to_null(_c("ocorrencia")).alias("ocorrencia"),
        days_between(actual, planned).cast("bigint").alias("dias_atraso"),
        *_lineage(),
        (_c("id_entrega").isNotNull() & _c("id_pedido").isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_custos(rows: DataFrame, strict: bool) -> DataFrame:
    value = to_numeric(_c("valor"), strict)
    return rows.select(
        to_bigint(_c("id_custo"), strict).alias("id_custo"),
        sql_trim(_c("centro_custo")).alias("centro_custo"),
        upper_trim(_c("tipo_custo")).alias("tipo_custo"),
        blank_to_null(_c("descricao")).alias("descricao"),
        value.alias("valor"),
        iso_date(_c("data_referencia"), strict).alias("data_referencia"),
        _c("competencia").alias("competencia"),
        *_lineage(),
        ((value > 0) & _c("data_referencia").isNotNull()).alias("_dq_ok"),
    )


@_model
def stg_perdas(rows: DataFrame, strict: bool) -> DataFrame:
    return rows.select(
        to_bigint(_c("id_perda"), strict).alias("id_perda"),
        sql_trim(_c("etapa")).alias("etapa"),
        sql_trim(_c("tipo_perda")).alias("tipo_perda"),
        iso_date(_c("data_perda"), strict).alias("data_perda"),
        to_numeric(blank_to_null(_c("volume_litros_ou_kg")), strict).alias("volume_litros_ou_kg"),
        to_numeric(blank_to_null(_c("valor_estimado")), strict).alias("valor_estimado"),
        to_bigint(blank_to_null(_c("id_cooperado")), strict).alias("id_cooperado"),
        to_bigint(blank_to_null(_c("id_producao")), strict).alias("id_producao"),
        to_bigint(blank_to_null(_c("id_entrega")), strict).alias("id_entrega"),
        blank_to_null(_c("descricao")).alias("descricao"),
        *_lineage(),
        (_c("id_perda").isNotNull() & _c("etapa").isNotNull() & _c("data_perda").isNotNull()).alias("_dq_ok"),
    )


def raw_key(model: str) -> Column:
    """The key that a model takes the newest row of, in bronze columns."""
    return _collection_field("id_coleta") if model == "stg_coletas" else _c(MODEL_KEYS[model])


# Silver model → its key column in bronze (collections have one in each layout).
MODEL_KEYS = {
    "stg_cooperados": "id_cooperado",
    "stg_fazendas": "id_fazenda",
    "stg_produtos": "id_produto",
    "stg_producao": "id_producao",
    "stg_clientes": "id_cliente",
    "stg_pedidos": "id_pedido",
    "stg_itens_pedido": "id_item",
    "stg_rotas": "id_rota",
    "stg_entregas": "id_entrega",
    "stg_custos": "id_custo",
    "stg_perdas": "id_perda",
}

KEY_COLUMNS = {m: (c,) for m, c in MODEL_KEYS.items()} | {"stg_coletas": COLLECTION_FIELDS["id_coleta"]}

# silver model → (bronze table, builder)
SILVER_MODELS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "stg_cooperados": ("cooperados", stg_cooperados),
    "stg_fazendas": ("fazendas", stg_fazendas),
    "stg_coletas": ("coletas", stg_coletas),
    "stg_produtos": ("produtos", stg_produtos),
    "stg_producao": ("producao", stg_producao),
    "stg_clientes": ("clientes", stg_clientes),
    "stg_pedidos": ("pedidos", stg_pedidos),
    "stg_itens_pedido": ("itens_pedido", stg_itens_pedido),
    "stg_rotas": ("rotas", stg_rotas),
    "stg_entregas": ("entregas", stg_entregas),
    "stg_custos": ("custos_operacionais", stg_custos),
    "stg_perdas": ("perdas", stg_perdas),
}


def comparable(df: DataFrame) -> DataFrame:
    """Drop load-time metadata and render decimals as DOUBLE for cross-engine checks."""
    out = []
    for field in df.schema.fields:
        if field.name == "_ingested_at":
            continue
        c = F.col(f"`{field.name}`")
        out.append(as_double(c).alias(field.name) if field.dataType.typeName() == "decimal" else c)
    return df.select(*out)
