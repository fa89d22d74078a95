"""DuckDB SQL for every registered query, from rules and constants of its own.

Nothing here is imported from the implementation: the list of loads, the collection
layouts and the clean-up lists are stated again, so a wrong mapping there cannot agree
with itself. A statement is built from small parts:

    raw files (fixture_sql) → one table of stamped loads → newest rows → typed model → query

Models are tables of (output, kind, source) that one function turns into SQL; the profit
and loss report sums one ledger of typed entries instead of joining monthly tables.

Numeric recipe shared with the Spark side: exact DECIMAL sums; averages and ratios as
DOUBLE division of exact sums; DOUBLE rounded half-up through DECIMAL(38,10); every
measure returned as DOUBLE.
"""

from __future__ import annotations

from dataclasses import dataclass

from curdle.oracle.fixture_sql import FIXTURE_SQL

# ── the loads ────────────────────────────────────────────────────────────────


@dataclass(frozen=True)
class Load:
    file: str
    table: str
    raw: str  # fixture CTE
    columns: tuple[str, ...]
    dates: tuple[str, ...] = ()
    layout: str | None = None
    commas: tuple[str, ...] = ()  # measures with decimal commas


def _load(file: str, columns: str, dates: str = "", table: str | None = None, layout: str | None = None, commas: str = "", raw: str | None = None) -> Load:
    table = table or file.removesuffix(".csv")
    return Load(file, table, raw or f"raw_{table}", tuple(columns.split()), tuple(dates.split()), layout, tuple(commas.split()))


# The source files in load order, their columns, and which need clean-up.
_A = "id_coleta id_fazenda id_rota data_coleta volume_litros temperatura_c gordura_pct proteina_pct acidez"
_B = "collection_id farm_id route_id collection_date collected_liters temperature_c fat_pct protein_pct acidity"
_C = "c_coleta_id c_id_fazenda c_id_rota c_data c_volume c_temperatura c_gordura c_proteina c_acidez c_observacao"
LOADS = [
    _load("cooperados.csv", "id_cooperado nome cpf_cnpj data_adesao situacao", "data_adesao"),
    _load("fazendas.csv", "id_fazenda id_cooperado nome_fazenda municipio area_hectares qtd_animais_lactacao raca_predominante"),
    _load("coletas_fonte_a.csv", _A, "", "coletas", "fonte_a", raw="raw_coletas_a"),
    _load("coletas_fonte_b.csv", _B, "", "coletas", "fonte_b", "collected_liters temperature_c fat_pct protein_pct acidity", "raw_coletas_b"),
    _load("coletas_fonte_c.csv", _C, "", "coletas", "fonte_c", "c_volume c_temperatura c_gordura c_proteina c_acidez", "raw_coletas_c"),
    _load("produtos.csv", "id_produto nome_produto categoria unidade preco_venda custo_unitario ativo"),
    _load("producao.csv", "id_producao id_produto data_producao linha_producao volume_entrada_litros volume_saida custo_total lote validade", "data_producao validade"),
    _load("clientes.csv", "id_cliente nome_cliente segmento estado cidade cnpj ativo"),
    _load("pedidos.csv", "id_pedido id_cliente data_pedido status canal desconto_pct", "data_pedido"),
    _load("itens_pedido.csv", "id_item id_pedido id_produto quantidade preco_unitario valor_total"),
    _load("rotas.csv", "id_rota nome_rota municipio_origem km_total veiculo_tipo ativa"),
    _load("entregas.csv", "id_entrega id_pedido id_rota data_prevista data_realizada status_entrega km_percorrido custo_frete ocorrencia", "data_prevista data_realizada"),
    _load("custos_operacionais.csv", "id_custo centro_custo tipo_custo descricao valor data_referencia competencia", "data_referencia"),
    _load("perdas.csv", "id_perda etapa tipo_perda data_perda volume_litros_ou_kg valor_estimado id_cooperado id_producao id_entrega descricao", "data_perda"),
]
WIDE = [*_A.split(), *_B.split(), *_C.split()]
TABLES = list(dict.fromkeys(x.table for x in LOADS))
_KEY_OF = {x.table: x.columns[0] for x in LOADS} | {"coletas": "coalesce(id_coleta, collection_id, c_coleta_id)"}
#: What Python's str.strip removes.
_STRIP = " || ".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace())


def loads_of(table: str) -> list[Load]:
    return [x for x in LOADS if x.table == table]


# ── expressions ──────────────────────────────────────────────────────────────


def stripped(x: str) -> str:
    return f"trim({x}, {_STRIP})"


def iso_text(x: str) -> str:
    """A raw date as year-month-day text: kept if it looks so, turned round if it is in slashes, else null."""
    s = stripped(x)
    piece = lambda i: f"string_split({s}, '/')[{i}]"
    # Zeros go before one digit, but behind a lone sign.
    two = lambda i: f"if({piece(i)} IN ('+', '-'), {piece(i)} || '0', repeat('0', 2 - length({piece(i)})) || {piece(i)})"
    slashes = f"length({s}) - length(replace({s}, '/', ''))"
    return f"CASE WHEN length({s}) = 10 AND {s}[5] = '-' THEN {s} WHEN {slashes} = 2 THEN {piece(3)} || '-' || {two(2)} || '-' || {two(1)} END"


def point(x: str) -> str:
    return f"nullif(replace({stripped(x)}, ',', '.'), '')"


def parsed(x: str, *formats: str) -> str:
    """Text as DATE by the first format whose shape it has."""
    shapes = {"%Y-%m-%d": "\\d{4}-\\d{2}-\\d{2}", "%d/%m/%Y": "\\d{2}/\\d{2}/\\d{4}", "%m-%d-%Y": "\\d{2}-\\d{2}-\\d{4}"}
    return "CASE " + " ".join(f"WHEN regexp_full_match({x}, '{shapes[f]}') THEN strptime({x}, '{f}')::DATE" for f in formats) + " END"


def exact(x: str) -> str:
    return f"({x})::DECIMAL(18,4)"


def over(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def mean(x: str) -> str:
    return over(f"sum({x})", f"count({x})")


def rounded(x: str, digits: int) -> str:
    """A DOUBLE, half-up."""
    return f"round(({x})::DECIMAL(38,10), {digits})::DOUBLE"


def money(x: str, digits: int = 2) -> str:
    """An exact DECIMAL, half-up, as DOUBLE."""
    return f"round({x}, {digits})::DOUBLE"


def percent(a: str, b: str, digits: int) -> str:
    return rounded(f"{over(a, b)} * 100", digits)


def month_of(x: str) -> str:
    return f"date_trunc('month', {x})::DATE"


def content_hash(columns) -> str:
    """Fields by name, each with the length of its value, so that no value can stand for two fields."""
    fields = ", ".join(f"coalesce('{c}=' || length({c}) || ':' || {c}, '{c}␀')" for c in sorted(columns))
    return f"md5(concat_ws(chr(31), {fields}))"


# ── loads → newest rows ──────────────────────────────────────────────────────


def _raw(names) -> list[str]:
    return [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in dict.fromkeys(names)]


def _stamped(x: Load, position: int) -> str:
    if x.layout:
        own = {c: point(c) if c in x.commas else c for c in x.columns}
        columns = {c: own.get(c, "NULL::VARCHAR") for c in WIDE}
    else:
        columns = {c: iso_text(c) if c in x.dates else c for c in x.columns}
    body = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    layout = f"'{x.layout}'" if x.layout else "NULL::VARCHAR"
    return f"SELECT *, {content_hash(columns)} AS _row_hash, '{x.file}' AS _source_file, {layout} AS _source_format, {position} AS _at FROM (SELECT {body}, _batch FROM {x.raw})"


def _loaded(table: str) -> list[str]:
    """bronze_<table> with its duplicate flag, and live_<table>: the newest unflagged row of each key."""
    every = " UNION ALL BY NAME ".join(_stamped(x, LOADS.index(x)) for x in loads_of(table))
    return [
        f"bronze_{table} AS (SELECT *, row_number() OVER same_content > 1 AS _is_duplicate FROM ({every}) WINDOW same_content AS (PARTITION BY _row_hash ORDER BY _batch, _at))",
        f"live_{table} AS (SELECT * FROM bronze_{table} WHERE NOT _is_duplicate QUALIFY row_number() OVER (PARTITION BY {_KEY_OF[table]} ORDER BY _batch DESC, _at DESC, _row_hash DESC) = 1)",
    ]


# ── typed models ─────────────────────────────────────────────────────────────

#: kind → SQL over a raw column; the kinds ending in # are exact decimals.
KINDS = {
    "id": lambda x: f"{x}::BIGINT",
    "id?": lambda x: f"nullif({x}, '')::BIGINT",
    "int": lambda x: f"{x}::INTEGER",
    "text": lambda x: f"trim({x})",
    "upper": lambda x: f"upper(trim({x}))",
    "raw": lambda x: x,
    "text?": lambda x: f"nullif({x}, '')",
    "day": lambda x: parsed(x, "%Y-%m-%d"),
    "anyday": lambda x: parsed(x, "%Y-%m-%d", "%d/%m/%Y", "%m-%d-%Y"),
    "line": lambda x: f"upper(trim(regexp_replace({x}, '\\s+', ' ')))",
    "yes": lambda x: f"coalesce(lower({x})[1] = 's', FALSE)",
    "#": exact,
    "?#": lambda x: exact(f"nullif({x}, '')"),
    ",#": lambda x: exact(f"replace(nullif({x}, ''), ',', '.')"),
}


@dataclass(frozen=True)
class Model:
    table: str
    columns: str  # "output kind [source]" separated by semicolons
    ok: str  # over the typed columns (t) and the raw ones (r)
    more: str = ""  # "output = SQL" over the typed columns, separated by semicolons
    decimals: str = ""  # of more


def _three(*names: str) -> str:
    return "coalesce(" + ", ".join(f"r.{n}" for n in names) + ")"


MODELS = {
    "stg_cooperados": Model(
        "cooperados", "id_cooperado id; nome text; data_adesao day; situacao upper",
        "t.id_cooperado IS NOT NULL AND t.nome IS NOT NULL AND t.data_adesao IS NOT NULL AND t.situacao IN ('ATIVO', 'INATIVO', 'SUSPENSO')",
    ),
    "stg_fazendas": Model(
        "fazendas", "id_fazenda id; id_cooperado id; nome_fazenda text; municipio text; area_hectares ?#; qtd_animais_lactacao ?#; raca_predominante upper",
        "r.id_fazenda IS NOT NULL AND r.nome_fazenda IS NOT NULL AND t.area_hectares > 0 AND t.qtd_animais_lactacao > 0",
    ),
    "stg_coletas": Model(
        "coletas",
        "; ".join(
            f"{out} {kind} {_three(*sources)}".replace(", ", ",")
            for out, kind, *sources in (
                ("id_coleta", "id", "id_coleta", "collection_id", "c_coleta_id"), ("id_fazenda", "id", "id_fazenda", "farm_id", "c_id_fazenda"),
                ("id_rota", "id", "id_rota", "route_id", "c_id_rota"), ("data_coleta", "anyday", "data_coleta", "collection_date", "c_data"),
                ("volume_litros_raw", ",#", "volume_litros", "collected_liters", "c_volume"), ("temperatura_c", ",#", "temperatura_c", "temperature_c", "c_temperatura"),
                ("acidez", ",#", "acidez", "acidity", "c_acidez"), ("gordura_pct", ",#", "gordura_pct", "fat_pct", "c_gordura"),
                ("proteina_pct", ",#", "proteina_pct", "protein_pct", "c_proteina"),
            )
        )
        + "; _source_format raw",
        "t.volume_litros_raw > 0 AND t.data_coleta IS NOT NULL AND t.id_fazenda IS NOT NULL",
        "volume_litros = if(t.volume_litros_raw < 0, NULL, t.volume_litros_raw)", "volume_litros",
    ),
    "stg_produtos": Model(
        "produtos", "id_produto id; nome_produto text; categoria text; unidade upper; preco_venda ?#; custo_unitario #; ativo upper",
        "r.id_produto IS NOT NULL AND r.nome_produto IS NOT NULL AND t.preco_venda > 0 AND t.custo_unitario > 0",
    ),
    "stg_producao": Model(
        "producao",
        "id_producao id; id_produto id; data_producao day; linha_producao line; volume_entrada_litros #; volume_saida #; custo_total ?#; lote raw; validade day",
        "r.id_producao IS NOT NULL AND t.volume_entrada_litros > 0",
        f"rendimento_pct = {exact(rounded(over('t.volume_saida', 't.volume_entrada_litros'), 4))}", "rendimento_pct",
    ),
    "stg_clientes": Model(
        "clientes", "id_cliente id; nome_cliente text; segmento upper; uf text estado; cidade text; documento raw cnpj; ativo yes",
        "r.id_cliente IS NOT NULL AND r.nome_cliente IS NOT NULL AND r.cnpj IS NOT NULL",
    ),
    "stg_pedidos": Model(
        "pedidos", "id_pedido id; id_cliente id; data_pedido day; status upper; canal upper; desconto_pct ?#",
        "r.id_pedido IS NOT NULL AND r.id_cliente IS NOT NULL AND r.data_pedido IS NOT NULL",
    ),
    "stg_itens_pedido": Model(
        "itens_pedido", "id_item id; id_pedido id; id_produto id; quantidade int; preco_unitario_raw # preco_unitario; valor_total_raw ?# valor_total",
        "t.preco_unitario_raw > 0 AND t.quantidade > 0",
        f"preco_unitario = abs(t.preco_unitario_raw); valor_total = {exact('ifnull(t.valor_total_raw, t.quantidade * abs(t.preco_unitario_raw))')}; "
        "_dq_preco_negativo = t.preco_unitario_raw < 0; _dq_valor_total_imputado = t.valor_total_raw IS NULL",
        "preco_unitario valor_total",
    ),
    "stg_rotas": Model(
        "rotas", "id_rota id; nome_rota text; municipio_origem text; km_total #; veiculo_tipo text; ativo yes ativa", "r.id_rota IS NOT NULL AND t.km_total IS NOT NULL"
    ),
    "stg_entregas": Model(
        "entregas",
        "id_entrega id; id_pedido id; id_rota id; data_prevista day; data_realizada day; status_entrega upper; km_percorrido ?#; custo_frete ?#; ocorrencia text?",
        "r.id_entrega IS NOT NULL AND r.id_pedido IS NOT NULL", "dias_atraso = date_diff('day', t.data_prevista, t.data_realizada)",
    ),
    "stg_custos": Model(
        "custos_operacionais", "id_custo id; centro_custo text; tipo_custo upper; descricao text?; valor #; data_referencia day; competencia raw",
        "t.valor > 0 AND r.data_referencia IS NOT NULL",
    ),
    "stg_perdas": Model(
        "perdas",
        "id_perda id; etapa text; tipo_perda text; data_perda day; volume_litros_ou_kg ?#; valor_estimado ?#; id_cooperado id?; id_producao id?; id_entrega id?; descricao text?",
        "r.id_perda IS NOT NULL AND r.etapa IS NOT NULL AND r.data_perda IS NOT NULL",
    ),
}


def _typed(name: str) -> str:
    """One CTE: the raw row (r), its typed columns (t), and what follows from both."""
    m = MODELS[name]
    columns = []
    for item in m.columns.split("; "):
        out, kind, *given = item.split(" ", 2)
        source = given[0] if given else out
        columns.append(f"{KINDS[kind](source if '(' in source else f'r.{source}')} AS {out}")
    more = ["{1} AS {0}".format(*x.split(" = ", 1)) for x in m.more.split("; ") if x]
    tail = ", ".join(["t.*", "r._row_hash", "r._source_file", *more, f"({m.ok}) AS _dq_ok"])
    return f"{name} AS (SELECT {tail} FROM live_{m.table} r, LATERAL (SELECT {', '.join(columns)}) t)"


def decimals_of(name: str) -> list[str]:
    m = MODELS[name]
    return [c.split(" ")[0] for c in m.columns.split("; ") if c.split(" ")[1].endswith("#")] + m.decimals.split()


def with_ctes(models: list[str], tables: list[str] = (), more: list[str] = ()) -> str:
    tables = list(dict.fromkeys([MODELS[m].table for m in models] + list(tables)))
    ctes = _raw(x.raw for t in tables for x in loads_of(t))
    for t in tables:
        ctes += _loaded(t)
    return "WITH " + ",\n".join([*ctes, *map(_typed, models), *more]) + "\n"


# Registered names of the models.
SILVER_KEYS = {f"s{i:02d}_{m.removeprefix('stg_')}": m for i, m in enumerate(MODELS, 1)}


def silver_queries() -> dict[str, str]:
    out = {}
    for key, m in SILVER_KEYS.items():
        doubles = ", ".join(f"{c}::DOUBLE AS {c}" for c in decimals_of(m))
        out[key] = with_ctes([m]) + f"SELECT *{f' REPLACE ({doubles})' if doubles else ''} FROM {m}"
    return out


# ── monthly reports ──────────────────────────────────────────────────────────


def _report(facts: str, dims: str, measures: dict[str, str]) -> str:
    return f"SELECT {dims}, " + ", ".join(f"{sql} AS {name}" for name, sql in measures.items()) + f" FROM {facts} GROUP BY ALL"


_COLLECTIONS = f"""(SELECT {month_of('data_coleta')} AS mes, * FROM stg_coletas WHERE data_coleta IS NOT NULL)
  LEFT JOIN (SELECT id_fazenda, nome_fazenda, municipio, id_cooperado FROM stg_fazendas) USING (id_fazenda)
  LEFT JOIN (SELECT id_cooperado, nome AS nome_cooperado FROM stg_cooperados) USING (id_cooperado)"""
_PRODUCTION = f"""(SELECT {month_of('data_producao')} AS mes, volume_entrada_litros - volume_saida AS lost, * FROM stg_producao WHERE _dq_ok)
  LEFT JOIN (SELECT id_produto, categoria AS categoria_produto, nome_produto FROM stg_produtos) USING (id_produto)"""
_DELIVERIES = f"""(SELECT {month_of('data_prevista')} AS mes, ifnull(dias_atraso, 0) <= 0 AS in_time, * FROM stg_entregas WHERE _dq_ok AND data_prevista IS NOT NULL)
  LEFT JOIN (SELECT id_rota, nome_rota, municipio_origem, veiculo_tipo FROM stg_rotas) USING (id_rota)"""
_LOSSES = f"(SELECT {month_of('data_perda')} AS mes, * FROM stg_perdas WHERE _dq_ok AND data_perda IS NOT NULL)"

G01 = _report(_COLLECTIONS, "mes, id_fazenda, nome_fazenda, municipio, nome_cooperado", {
    "qtd_coletas": "count(*)", "volume_total_litros": money("sum(volume_litros)", 0), "volume_medio_por_coleta": rounded(mean("volume_litros"), 1),
    "gordura_media_pct": rounded(mean("gordura_pct"), 3), "proteina_media_pct": rounded(mean("proteina_pct"), 3), "acidez_media": rounded(mean("acidez"), 2),
    "temperatura_media_c": rounded(mean("temperatura_c"), 1), "pct_coletas_validas": percent("count(*) FILTER (_dq_ok)", "count(*)", 1),
})
G02 = _report(_PRODUCTION, "mes, linha_producao, categoria_produto, nome_produto", {
    "qtd_ordens": "count(*)", "total_entrada_litros": money("sum(volume_entrada_litros)", 0), "total_saida": money("sum(volume_saida)", 0),
    "rendimento_medio_pct": rounded(mean("rendimento_pct") + " * 100", 2), "perda_processo_litros": money("sum(lost)", 0),
    "pct_perda_processo": percent("sum(lost)", "sum(volume_entrada_litros)", 2), "custo_total": money("sum(custo_total)"),
    "custo_por_unidade_saida": rounded(over("sum(custo_total)", "sum(volume_saida)"), 4),
})
G03 = _report(_DELIVERIES, "mes, id_rota, nome_rota, municipio_origem, veiculo_tipo", {
    "qtd_entregas": "count(*)", "qtd_entregues": "count(*) FILTER (status_entrega = 'ENTREGUE')", "qtd_devolvidas": "count(*) FILTER (status_entrega = 'DEVOLVIDO')",
    "qtd_pendentes": "count(*) FILTER (status_entrega = 'PENDENTE')", "qtd_no_prazo": "count(*) FILTER (in_time)", "pct_no_prazo": percent("count(*) FILTER (in_time)", "count(*)", 1),
    "atraso_medio_dias": rounded(mean("dias_atraso"), 1), "atraso_maximo_dias": "max(dias_atraso)", "custo_frete_total": money("sum(custo_frete)"),
    "custo_frete_medio": rounded(mean("custo_frete"), 2), "km_medio": rounded(mean("km_percorrido"), 1), "custo_por_km": rounded(over("sum(custo_frete)", "sum(km_percorrido)"), 4),
})


def _in_order(sql: str, first: str) -> str:
    """Rows with their place in the report's order; ties go by the other columns as they stand, nulls first."""
    return f"SELECT *, row_number() OVER (ORDER BY {first}) AS row_no FROM ({sql})"


def _ties(*columns: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _losses(*grain: str) -> str:
    """Sums of each group first, then each group's share of its month."""
    sums = f"SELECT mes, etapa, tipo_perda, count(*) AS n, sum(volume_litros_ou_kg) AS amount, sum(valor_estimado) AS worth, count(valor_estimado) AS priced FROM {_LOSSES} GROUP BY {', '.join(('mes', 'etapa', 'tipo_perda', *grain))}"
    share = percent("worth", "sum(worth) OVER (PARTITION BY mes)", 2)
    return (
        f"SELECT mes, etapa, tipo_perda, n AS qtd_ocorrencias, {money('amount', 1)} AS volume_perdido, {money('worth')} AS valor_perdido, "
        f"{rounded(over('worth', 'priced'), 2)} AS valor_medio_por_ocorrencia, {share} AS pct_valor_no_mes FROM ({sums})"
    )


# The ledger: every amount of the profit and loss report as (month, account, amount, order). Discounts are held
# as amount times percent, exactly, and divided by 100 once in a sum.
LEDGER_MODELS = ["stg_pedidos", "stg_itens_pedido", "stg_custos", "stg_perdas", "stg_entregas"]
LEDGER = [
    f"""sold AS (SELECT {month_of('data_pedido')} AS mes, id_pedido, valor_total, ifnull(desconto_pct, 0::DECIMAL(18,4)) AS pct
      FROM stg_pedidos INNER JOIN (SELECT id_pedido, valor_total FROM stg_itens_pedido WHERE _dq_ok) USING (id_pedido) WHERE _dq_ok AND status <> 'CANCELADO')""",
    f"""ledger AS (
      SELECT mes, 'gross' AS account, valor_total::DECIMAL(38,8) AS amount, id_pedido FROM sold
      UNION ALL SELECT mes, 'discount', (valor_total * pct)::DECIMAL(38,8), NULL FROM sold
      UNION ALL SELECT {month_of('data_referencia')}, 'type ' || tipo_custo, valor::DECIMAL(38,8), NULL FROM stg_custos WHERE _dq_ok
      UNION ALL SELECT {month_of('data_referencia')}, 'centre ' || centro_custo, valor::DECIMAL(38,8), NULL FROM stg_custos WHERE _dq_ok
      UNION ALL SELECT {month_of('data_referencia')}, 'cost', valor::DECIMAL(38,8), NULL FROM stg_custos WHERE _dq_ok
      UNION ALL SELECT {month_of('data_perda')}, 'loss', valor_estimado::DECIMAL(38,8), NULL FROM stg_perdas WHERE _dq_ok
      UNION ALL SELECT {month_of('data_realizada')}, 'freight', custo_frete::DECIMAL(38,8), NULL FROM stg_entregas WHERE _dq_ok AND data_realizada IS NOT NULL)""",
]


def _account(*names: str) -> str:
    return f"sum(amount) FILTER (account IN ({', '.join(repr(n) for n in names)}))"


def _zero(x: str) -> str:
    return f"ifnull({x}, 0::DECIMAL(38,8))"


_GROSS = _account("gross")
_DISCOUNT = f"({_account('discount')}::DECIMAL(36,8) * 0.01::DECIMAL(2,2))"
_NET = f"({_GROSS} - {_DISCOUNT})"
_COSTS = {
    "custo_fixo": "type FIXO", "custo_variavel": "type VARIÁVEL", "custo_producao": "centre Produção", "custo_coleta": "centre Coleta",
    "custo_logistica": "centre Logística", "custo_comercial": "centre Comercial", "custo_administrativo": "centre Administrativo",
}
_REVENUE = {"receita_bruta": money(_GROSS), "desconto_total": money(_DISCOUNT), "receita_liquida": money(_NET), "qtd_pedidos": "count(DISTINCT id_pedido)"}
_LEFT = f"({_NET} - {_zero(_account('cost'))} - {_zero(_account('freight'))} - {_zero(_account('loss'))})"
G05 = _report("ledger", "mes", _REVENUE | {n: money(_zero(_account(a))) for n, a in _COSTS.items()} | {
    "custo_frete": money(_zero(_account("freight"))), "valor_perdas": money(_zero(_account("loss"))), "resultado_estimado": money(_LEFT), "margem_pct": percent(_LEFT, _NET, 2),
}) + f" HAVING {_account('gross')} IS NOT NULL"


def _part(measures: dict[str, str], *accounts: str) -> str:
    return _report(f"(FROM ledger WHERE {' OR '.join(f'starts_with(account, {a!r})' for a in accounts)})", "mes", measures)


def gold_queries() -> dict[str, str]:
    ledger = with_ctes(LEDGER_MODELS, more=LEDGER)
    costs = {n: money(_zero(_account(a))) for n, a in _COSTS.items()} | {"custo_total": money(_account("cost"))}
    return {
        "g01_coleta_fazenda_mensal": with_ctes(["stg_coletas", "stg_fazendas", "stg_cooperados"]) + _in_order(
            G01, "mes, volume_total_litros DESC NULLS FIRST, " + _ties(
                "id_fazenda", "nome_fazenda", "municipio", "nome_cooperado", "qtd_coletas", "volume_medio_por_coleta", "gordura_media_pct", "proteina_media_pct", "acidez_media")),
        "g02_eficiencia_producao": with_ctes(["stg_producao", "stg_produtos"]) + _in_order(
            G02, "mes, rendimento_medio_pct DESC NULLS FIRST, " + _ties("linha_producao", "categoria_produto", "nome_produto")),
        "g03_logistica_sla": with_ctes(["stg_entregas", "stg_rotas"]) + _in_order(
            G03, "mes, pct_no_prazo, " + _ties("id_rota", "nome_rota", "municipio_origem", "veiculo_tipo")),
        "g04_perdas_consolidado": with_ctes(["stg_perdas"]) + _in_order(
            _losses("data_perda"), "mes, valor_perdido DESC NULLS FIRST, " + _ties("etapa", "tipo_perda", "qtd_ocorrencias", "volume_perdido", "valor_medio_por_ocorrencia", "pct_valor_no_mes")),
        "g04b_perdas_month_grain": with_ctes(["stg_perdas"]) + _losses(),
        "g05_resultado_mensal": ledger + _in_order(G05, "mes"),
        "g05a_receita": ledger + _part(_REVENUE, "gross", "discount"),
        "g05b_custos": ledger + _part(costs, "type ", "centre ", "cost"),
        "g05c_perdas": ledger + _part({"valor_perdas": money(_account("loss"))}, "loss"),
        "g05d_frete": ledger + _part({"custo_frete_total": money(_account("freight"))}, "freight"),
    }


# ── declared tests ───────────────────────────────────────────────────────────

# The declared tests. Keys are not null and unique; references are not null and have a parent.
_KEYS = {m: MODELS[m].columns.split(" ", 1)[0] for m in MODELS}
_REFERENCES = [
    ("stg_fazendas", "id_cooperado", "stg_cooperados"), ("stg_coletas", "id_fazenda", "stg_fazendas"), ("stg_pedidos", "id_cliente", "stg_clientes"),
    ("stg_itens_pedido", "id_pedido", "stg_pedidos"), ("stg_itens_pedido", "id_produto", "stg_produtos"), ("stg_entregas", "id_pedido", "stg_pedidos"),
    ("stg_producao", "id_produto", "stg_produtos"),
]
_PRESENT = [
    ("stg_cooperados", "nome"), ("stg_cooperados", "situacao"), ("stg_coletas", "data_coleta"), ("stg_coletas", "volume_litros"),
    ("stg_custos", "centro_custo"), ("stg_perdas", "etapa"),
]
_LISTS = [
    ("stg_cooperados", "situacao", ("ATIVO", "INATIVO", "SUSPENSO")),
    ("stg_pedidos", "status", ("FATURADO", "EM SEPARAÇÃO", "ENTREGUE", "CANCELADO")),
    ("stg_custos", "centro_custo", ("Coleta", "Produção", "Logística", "Comercial", "Administrativo")),
    ("stg_perdas", "etapa", ("Coleta", "Produção", "Estoque", "Transporte")),
]
_WARN = ("stg_coletas", "volume_litros", "not_null")


def _checks() -> list[tuple[str, str, str, str, tuple[str, ...]]]:
    """(model, column, test, SQL that lists the failures, models it reads)"""
    out = []
    for m, c in [*_KEYS.items(), *((m, c) for m, c, _ in _REFERENCES), *_PRESENT]:
        out.append((m, c, "not_null", f"FROM {m} WHERE {c} IS NULL", (m,)))
    for m, c in _KEYS.items():
        out.append((m, c, "unique", f"FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)", (m,)))
    for m, c, values in _LISTS:
        out.append((m, c, "accepted_values", f"FROM (SELECT DISTINCT {c} FROM {m} WHERE {c} NOT IN {values})", (m,)))
    for m, c, parent in _REFERENCES:
        out.append((m, c, "relationships", f"FROM {m} WHERE {c} IS NOT NULL AND NOT EXISTS (FROM {parent} p WHERE p.{_KEYS[parent]} = {m}.{c})", (m, parent)))
    return out


def _suite(*tests: str) -> str:
    chosen = [x for x in _checks() if x[2] in tests]
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, '{'warn' if (m, c, t) == _WARN else 'error'}' AS severity, (SELECT count(*) {sql}) AS failures"
        for m, c, t, sql, _ in chosen
    )
    models = [m for m in MODELS if any(m in reads for *_, reads in chosen)]
    return with_ctes(models) + f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM ({rows})"


def quality_queries() -> dict[str, str]:
    strays = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS column_name, {c} AS value, count(*) AS n_records FROM {m} WHERE {c} NOT IN {values} GROUP BY {c}" for m, c, values in _LISTS
    )
    return {
        "q01_not_null": _suite("not_null"),
        "q02_unique": _suite("unique"),
        "q03_accepted_values": with_ctes([m for m, *_ in _LISTS]) + strays,
        "q04_relationships": _suite("relationships"),
        "q05_suite_summary": _suite("not_null", "unique", "accepted_values", "relationships"),
    }


# ── single operators ─────────────────────────────────────────────────────────


def operator_queries() -> dict[str, str]:
    def q(models: str, sql: str, tables: str = "") -> str:
        return with_ctes(models.split(), tables.split()) + sql

    month_share = f"SELECT {month_of('data_perda')} AS mes, etapa, sum(valor_estimado) AS worth FROM stg_perdas WHERE _dq_ok AND data_perda IS NOT NULL GROUP BY ALL"
    flags = "SELECT 'clientes' AS source, id_cliente AS record_key, ativo AS raw_value FROM live_clientes UNION ALL SELECT 'rotas', id_rota, ativa FROM live_rotas"
    return {
        "o01_latest_by_key": q("", "SELECT id_pedido, status, _batch::BIGINT AS _batch_id, _row_hash FROM live_pedidos", "pedidos"),
        "o02_left_join_enrich": q(
            "stg_coletas stg_fazendas",
            "SELECT id_coleta, id_fazenda, nome_fazenda, municipio, f.id_cooperado FROM stg_coletas LEFT JOIN stg_fazendas f USING (id_fazenda)",
        ),
        "o03_inner_join": q(
            "stg_pedidos stg_itens_pedido",
            "SELECT id_pedido, id_item, data_pedido, valor_total::DOUBLE AS valor_total, desconto_pct::DOUBLE AS desconto_pct "
            "FROM (FROM stg_pedidos WHERE _dq_ok AND status <> 'CANCELADO') JOIN (SELECT id_pedido, id_item, valor_total FROM stg_itens_pedido WHERE _dq_ok) USING (id_pedido)",
        ),
        "o04_count_distinct": q("stg_pedidos", _report("stg_pedidos", f"{month_of('data_pedido')} AS mes", {"qtd_clientes": "count(DISTINCT id_cliente)", "qtd_pedidos": "count(*)"})),
        "o05_conditional_agg": q("stg_custos", _report("(FROM stg_custos WHERE _dq_ok)", "competencia", {
            n: money(f"ifnull(sum(valor) FILTER (tipo_custo = '{t}'), 0::DECIMAL(38,4))") for n, t in (("custo_fixo", "FIXO"), ("custo_variavel", "VARIÁVEL"))
        } | {"custo_total": money("sum(valor)")})),
        "o06_safe_ratio": q("stg_entregas", _report("(FROM stg_entregas WHERE _dq_ok)", "id_rota", {"custo_por_km": rounded(over("sum(custo_frete)", "sum(km_percorrido)"), 4)})),
        "o07_share_of_period": q(
            "stg_perdas", f"SELECT mes, etapa, {money('worth')} AS valor_perdido, {percent('worth', 'sum(worth) OVER (PARTITION BY mes)', 2)} AS pct_valor_no_mes FROM ({month_share})"
        ),
        "o08_month_bucket": q("stg_coletas", _report("(FROM stg_coletas WHERE data_coleta IS NOT NULL)", f"{month_of('data_coleta')} AS mes", {"qtd_coletas": "count(*)"})),
        "o09_sla_days": q("stg_entregas", "SELECT id_entrega, data_prevista, data_realizada, dias_atraso FROM stg_entregas"),
        "o10_text_flag": q("", f"SELECT *, {KINDS['yes']('raw_value')} AS ativo FROM ({flags})", "clientes rotas"),
        "o11_impute_total": q(
            "stg_itens_pedido",
            "SELECT id_item, quantidade, _dq_valor_total_imputado, COLUMNS(['preco_unitario', 'valor_total_raw', 'valor_total'])::DOUBLE FROM stg_itens_pedido",
        ),
        "o12_abs_price": q("stg_itens_pedido", "SELECT id_item, _dq_preco_negativo, COLUMNS(['preco_unitario_raw', 'preco_unitario'])::DOUBLE FROM stg_itens_pedido"),
        "o13_regexp_replace_first": q(
            "", f"SELECT linha_producao AS linha_raw, {KINDS['line']('linha_producao')} AS linha_producao, count(*) AS qtd FROM live_producao GROUP BY linha_raw", "producao"
        ),
    }


# ── loads ────────────────────────────────────────────────────────────────────


def bronze_queries() -> dict[str, str]:
    def union(parts) -> str:
        return " UNION ALL BY NAME ".join(f"({p})" for p in parts)

    dated = [x for x in LOADS if x.dates]
    dates = union(
        f"SELECT '{x.file}' AS source_file, {x.columns[0]} AS record_key, _batch::BIGINT AS _batch_id, '{c}' AS column_name, {c} AS raw_value, {iso_text(c)} AS normalized FROM {x.raw}"
        for x in dated for c in x.dates
    )
    measured = [x for x in LOADS if x.commas]
    measures = union(
        f"SELECT '{x.file}' AS source_file, {x.columns[0]} AS record_key, '{c}' AS column_name, {c} AS raw_value, {point(c)} AS cleaned FROM {x.raw}"
        for x in measured for c in x.commas
    )
    place = "_source_file, _batch::BIGINT AS _batch_id"
    every = lambda more="": union(f"SELECT '{t}' AS table_name, {place}, _row_hash{more} FROM bronze_{t}" for t in TABLES)
    loaded = " UNION ALL BY NAME ".join(f"SELECT '{x.table}' AS table_name, '{x.file}' AS source_file, {LOADS.index(x)} AS _at" for x in LOADS)
    counted = union(f"SELECT _source_file, _batch, count(*) AS n, count(*) FILTER (_is_duplicate) AS dup FROM bronze_{t} GROUP BY ALL" for t in TABLES)
    # Runs come in order, and in a run the files that it has come in the order of the list.
    log = (
        "SELECT table_name, source_file, _batch::BIGINT AS _batch_id, n AS rows_read, n - dup AS rows_inserted, 0::BIGINT AS rows_updated, dup AS rows_skipped, "
        "0::BIGINT AS rows_quarantined, 'SUCCESS' AS status, NULL::VARCHAR AS error_msg, row_number() OVER (ORDER BY _batch, _at) AS row_no "
        f"FROM ({counted}) JOIN ({loaded}) ON _source_file = source_file"
    )
    with_raw = lambda loads: "WITH " + ",\n".join(_raw(x.raw for x in loads)) + "\n"
    appended = union(f"SELECT *, '{x.file}' AS _source_file FROM {x.raw}" for x in loads_of("coletas"))
    return {
        "b01_normalize_date": with_raw(dated) + dates,
        "b02_numeric_like": with_raw(measured) + measures,
        "b03_unify_collection_formats": with_ctes([], ["coletas"]) + f"SELECT {', '.join(WIDE)}, _source_format, {place}, _row_hash FROM bronze_coletas",
        "b04_row_hash": with_ctes([], TABLES) + every(),
        "b05_flag_duplicates_in_batch": with_ctes([], TABLES) + every(", _is_duplicate"),
        "b06_incremental_hash_dedup": with_ctes([], ["pedidos"])
        + "SELECT id_pedido, status, _row_hash, _is_duplicate FROM bronze_pedidos WHERE _batch = 2",
        "b07_ingestion_log": with_ctes([], TABLES) + log,
        "b09_rerun_flags": with_ctes([], ["pedidos"]) + "SELECT id_pedido, status, _batch::BIGINT AS _batch_id, _row_hash, _is_duplicate FROM bronze_pedidos",
        "b10_malformed_rows": """
            SELECT if(kind IN (3, 4), NULL, id) AS id_pedido, if(kind IN (3, 4), NULL, cust) AS cliente, CASE WHEN kind IN (1, 3, 4) THEN NULL WHEN kind = 2 THEN '' ELSE 'x; y' END AS nota,
                   CASE WHEN kind IN (1, 3, 4) THEN NULL WHEN kind = 2 THEN '' ELSE price END AS total,
                   CASE kind WHEN 3 THEN id || ';' || cust || ';a;b;c;' WHEN 4 THEN id || ';' || cust || ';"open;1' END AS quarantined
            FROM (SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS cust, o_orderkey % 11 AS kind, floor(o_totalprice)::BIGINT::VARCHAR AS price FROM orders)""",
        "b12_schema_versions": f"""
            WITH people AS (SELECT c_custkey::VARCHAR AS id_cliente, c_name AS nome_cliente, c_nationkey::VARCHAR AS cidade, c_mktsegment AS segmento FROM customer)
            SELECT *, row_number() OVER (PARTITION BY _row_hash ORDER BY _batch_id) > 1 AS _is_duplicate FROM (
              SELECT id_cliente, nome_cliente, NULL::VARCHAR AS cidade, NULL::VARCHAR AS segmento, 1::BIGINT AS _batch_id, {content_hash(['id_cliente', 'nome_cliente'])} AS _row_hash FROM people
              UNION ALL SELECT id_cliente, nome_cliente, cidade, NULL, 2, {content_hash(['id_cliente', 'nome_cliente', 'cidade'])} FROM people
              UNION ALL SELECT id_cliente, nome_cliente, cidade, segmento, 3, {content_hash(['id_cliente', 'nome_cliente', 'cidade', 'segmento'])} FROM people WHERE id_cliente::BIGINT % 2 = 0
              UNION ALL SELECT id_cliente, nome_cliente, cidade, NULL, 4, {content_hash(['id_cliente', 'nome_cliente', 'cidade'])} FROM people
            ), (SELECT string_agg(column_name || '=' || run, ',' ORDER BY run, column_name) AS columns_by_run FROM (VALUES ('id_cliente', 1), ('nome_cliente', 1), ('cidade', 2), ('segmento', 3)) v(column_name, run))""",
        "b11_quoted_breaks": f"""
            SELECT *, {content_hash(['id_cliente', 'nome_cliente', 'cidade'])} AS _row_hash, FALSE AS _is_duplicate FROM (
              SELECT o_orderkey::VARCHAR AS id_cliente, if(o_orderkey % 3 = 0, 'a' || chr(13) || chr(10) || o_orderstatus, '') AS cidade,
                CASE o_orderkey % 5 WHEN 0 THEN 'Cliente' || chr(10) || o_orderstatus || chr(10) || 'fim' WHEN 1 THEN '"' || o_orderpriority || '",' || chr(10) || '"' || chr(10)
                  WHEN 2 THEN chr(10) || chr(10) || o_orderkey ELSE 'nome, ' || o_orderkey END AS nome_cliente
              FROM orders)""",
        "b08_schema_evolution_union": with_raw(loads_of("coletas")) + f"SELECT * REPLACE (_batch::BIGINT AS _batch) FROM ({appended})",
    }


def all_queries() -> dict[str, str]:
    return bronze_queries() | silver_queries() | gold_queries() | quality_queries() | operator_queries()
