"""The source manifest: which delimited file feeds which bronze table, and how to read it."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    file: str  # file name inside the raw folder
    table: str  # bronze table (without layer prefix)
    key: str  # natural key column as named in the file
    date_cols: tuple[str, ...] = field(default_factory=tuple)  # normalised in bronze
    delimiter: str = ","
    source_format: str | None = None  # collection layouts only

    @property
    def position(self) -> int:
        """Load order inside one ingestion run (manifest order)."""
        return MANIFEST.index(self)


# The source manifest, in load order (file, bronze table, key,
# date columns, delimiter, layout tag). Three collection layouts share one table.
MANIFEST: list[SourceSpec] = [
    SourceSpec("cooperados.csv", "cooperados", "id_cooperado", ("data_adesao",)),
    SourceSpec("fazendas.csv", "fazendas", "id_fazenda"),
    SourceSpec("coletas_fonte_a.csv", "coletas", "id_coleta", (), ";", "fonte_a"),
    SourceSpec("coletas_fonte_b.csv", "coletas", "collection_id", (), ",", "fonte_b"),
    SourceSpec("coletas_fonte_c.csv", "coletas", "COLETA ID", (), ",", "fonte_c"),
    SourceSpec("produtos.csv", "produtos", "id_produto"),
    SourceSpec("producao.csv", "producao", "id_producao", ("data_producao", "validade")),
    SourceSpec("clientes.csv", "clientes", "id_cliente"),
    SourceSpec("pedidos.csv", "pedidos", "id_pedido", ("data_pedido",)),
    SourceSpec("itens_pedido.csv", "itens_pedido", "id_item"),
    SourceSpec("rotas.csv", "rotas", "id_rota"),
    SourceSpec("entregas.csv", "entregas", "id_entrega", ("data_prevista", "data_realizada")),
    SourceSpec("custos_operacionais.csv", "custos_operacionais", "id_custo", ("data_referencia",)),
    SourceSpec("perdas.csv", "perdas", "id_perda", ("data_perda",)),
]

BRONZE_TABLES: list[str] = list(dict.fromkeys(s.table for s in MANIFEST))


def spec_for_file(file: str) -> SourceSpec:
    for spec in MANIFEST:
        if spec.file == file:
            return spec
    raise KeyError(file)


def specs_for_table(table: str) -> list[SourceSpec]:
    return [s for s in MANIFEST if s.table == table]


# The wide collection layout. Each source layout keeps its own
# columns; the others are null. Layout C's headers ("COLETA ID", "ACIDEZ", …)
# collide case-insensitively with layout A's, so they carry a ``c_`` prefix.
COLLECTION_LAYOUTS: dict[str, dict[str, str]] = {
    # source_format: {file header: bronze column}
    "fonte_a": {
        "id_coleta": "id_coleta",
        "id_fazenda": "id_fazenda",
        "id_rota": "id_rota",
        "data_coleta": "data_coleta",
        "volume_litros": "volume_litros",
        "temperatura_c": "temperatura_c",
        "gordura_pct": "gordura_pct",
        "proteina_pct": "proteina_pct",
        "acidez": "acidez",
    },
    "fonte_b": {
        "collection_id": "collection_id",
        "farm_id": "farm_id",
        "route_id": "route_id",
        "collection_date": "collection_date",
        "collected_liters": "collected_liters",
        "temperature_c": "temperature_c",
        "fat_pct": "fat_pct",
        "protein_pct": "protein_pct",
        "acidity": "acidity",
    },
    "fonte_c": {
        "COLETA ID": "c_coleta_id",
        "ID FAZENDA": "c_id_fazenda",
        "ID ROTA": "c_id_rota",
        "DATA": "c_data",
        "VOLUME": "c_volume",
        "TEMPERATURA": "c_temperatura",
        "GORDURA": "c_gordura",
        "PROTEINA": "c_proteina",
        "ACIDEZ": "c_acidez",
        "OBSERVACAO": "c_observacao",
    },
}

# Measures that get decimal-comma clean-up per layout (layout A's do not).
COLLECTION_NUMERIC_LIKE: dict[str, tuple[str, ...]] = {
    "fonte_a": (),
    "fonte_b": ("collected_liters", "temperature_c", "fat_pct", "protein_pct", "acidity"),
    "fonte_c": ("c_volume", "c_temperatura", "c_gordura", "c_proteina", "c_acidez"),
}

COLLECTION_WIDE_COLUMNS: list[str] = [col for layout in COLLECTION_LAYOUTS.values() for col in layout.values()]
