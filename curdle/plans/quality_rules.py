"""The declared data-quality rules over the silver models (48 tests)."""

from __future__ import annotations

from curdle.operators.quality import Rule

# Accepted value lists as declared for the silver models.
SITUACAO = ("ATIVO", "INATIVO", "SUSPENSO")
STATUS_PEDIDO = ("FATURADO", "EM SEPARAÇÃO", "ENTREGUE", "CANCELADO")
# (cost centres as the data and the marts spell them)
CENTRO_CUSTO = ("Coleta", "Produção", "Logística", "Comercial", "Administrativo")
ETAPA = ("Coleta", "Produção", "Estoque", "Transporte")


def _key(model: str, column: str) -> list[Rule]:
    return [Rule(model, column, "not_null"), Rule(model, column, "unique")]


def _fk(model: str, column: str, parent: str, parent_column: str) -> list[Rule]:
    return [Rule(model, column, "not_null"), Rule(model, column, "relationships", parent=parent, parent_column=parent_column)]


RULES: list[Rule] = [
    *_key("stg_cooperados", "id_cooperado"),
    Rule("stg_cooperados", "nome", "not_null"),
    Rule("stg_cooperados", "situacao", "not_null"),
    Rule("stg_cooperados", "situacao", "accepted_values", SITUACAO),
    *_key("stg_fazendas", "id_fazenda"),
    *_fk("stg_fazendas", "id_cooperado", "stg_cooperados", "id_cooperado"),
    *_key("stg_coletas", "id_coleta"),
    *_fk("stg_coletas", "id_fazenda", "stg_fazendas", "id_fazenda"),
    Rule("stg_coletas", "data_coleta", "not_null"),
    # Negative volumes become null by rule, so nulls are expected: a warning.
    Rule("stg_coletas", "volume_litros", "not_null", severity="warn"),
    *_key("stg_produtos", "id_produto"),
    *_key("stg_pedidos", "id_pedido"),
    *_fk("stg_pedidos", "id_cliente", "stg_clientes", "id_cliente"),
    Rule("stg_pedidos", "status", "accepted_values", STATUS_PEDIDO),
    *_key("stg_itens_pedido", "id_item"),
    *_fk("stg_itens_pedido", "id_pedido", "stg_pedidos", "id_pedido"),
    *_fk("stg_itens_pedido", "id_produto", "stg_produtos", "id_produto"),
    *_key("stg_entregas", "id_entrega"),
    *_fk("stg_entregas", "id_pedido", "stg_pedidos", "id_pedido"),
    *_key("stg_producao", "id_producao"),
    *_fk("stg_producao", "id_produto", "stg_produtos", "id_produto"),
    *_key("stg_custos", "id_custo"),
    Rule("stg_custos", "centro_custo", "not_null"),
    Rule("stg_custos", "centro_custo", "accepted_values", CENTRO_CUSTO),
    *_key("stg_perdas", "id_perda"),
    Rule("stg_perdas", "etapa", "not_null"),
    Rule("stg_perdas", "etapa", "accepted_values", ETAPA),
    *_key("stg_rotas", "id_rota"),
    *_key("stg_clientes", "id_cliente"),
]

assert len(RULES) == 48
