"""Files on disk through every layer equal the in-memory query path on the same data."""


import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from curdle.plans import pipeline
from curdle.plans.ingest import read_log
from curdle.plans.queries import all_queries
from curdle.plans.silver import comparable
from curdle.sources import catalog
from curdle.sources.store import Store
from curdle.functions.numeric import as_doubles
from fixture_files import write_fixture_files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("e2e")
    runs = write_fixture_files(spark, SF_SMALL, str(root / "raw"))
    wh = str(root / "wh")
    for batch, raw_dir in enumerate(runs, start=1):
        pipeline.run_bronze(spark, raw_dir, wh, batch)
    pipeline.run_silver(spark, wh)
    pipeline.run_gold(spark, wh)
    pipeline.run_tests(spark, wh)
    return wh


def test_log_counts(spark, warehouse):
    log = read_log(spark, warehouse)
    assert log.where("status != 'SUCCESS'").count() == 0
    assert log.where("rows_read != rows_inserted + rows_skipped").count() == 0
    per = {(r.source_file, r._batch_id): r for r in log.collect()}
    assert len(per) == 15  # 14 files in run 1, orders + layout C in run 2 ... minus C's absence in run 1
    assert per[("pedidos.csv", 2)].rows_skipped > 0  # unchanged re-sent orders are flagged
    assert {"pedidos", "coletas", "ingestion_log"} <= set(catalog.list_tables(spark, Store(spark, warehouse).database("bronze")))
    assert catalog.read(spark, Store(spark, warehouse).database("bronze"), "ingestion_log").count() == 15


@pytest.mark.parametrize("model,key", [("stg_pedidos", "s07_pedidos"), ("stg_coletas", "s03_coletas"), ("stg_itens_pedido", "s08_itens_pedido")])
def test_silver_equals_query_path(spark, warehouse, model, key):
    written = comparable(pipeline.read_model(spark, warehouse, "silver", model))
    expected = all_queries()[key](spark, SF_SMALL)
    assert rows(written.select(*expected.columns)) == rows(expected)


@pytest.mark.parametrize(
    "mart,key",
    [
        ("mart_resultado_mensal", "g05_resultado_mensal"),
        ("mart_coleta_fazenda_mensal", "g01_coleta_fazenda_mensal"),
        ("mart_perdas_consolidado", "g04_perdas_consolidado"),
    ],
)
def test_gold_equals_query_path(spark, warehouse, mart, key):
    written = as_doubles(pipeline.read_model(spark, warehouse, "gold", mart))
    expected = all_queries()[key](spark, SF_SMALL)
    assert rows(written) == rows(expected.drop("row_no"))


def test_quality_summary(spark, warehouse):
    res = pipeline.read_model(spark, warehouse, "gold", "dq_test_results")
    assert res.count() == 48
    got = {(r.model, r.column_name, r.test): r.status for r in res.collect()}
    strays = {(r.model, r.column_name): r.failures for r in res.where("test = 'accepted_values'").collect()}
    assert strays[("stg_custos", "centro_custo")] == 2 and strays[("stg_perdas", "etapa")] == 1  # values that no list has
    assert got[("stg_coletas", "volume_litros", "not_null")] == "warn"
    assert got[("stg_pedidos", "id_pedido", "unique")] == "pass"
    expected = all_queries()["q05_suite_summary"](spark, SF_SMALL)
    assert rows(res.select(*expected.columns)) == rows(expected)


def test_day_grain_shares_sum_to_100(spark, warehouse):
    mart = pipeline.read_model(spark, warehouse, "gold", "mart_perdas_consolidado")
    per_month = mart.groupBy("mes").agg(F.sum(F.col("pct_valor_no_mes").cast("double")).alias("s"), F.count("*").alias("n")).collect()
    for r in per_month:
        assert abs(r.s - 100.0) <= 0.005 * r.n + 1e-9


def test_silver_keys_unique_and_views(spark, warehouse):
    s = pipeline.read_model(spark, warehouse, "silver", "stg_itens_pedido")
    assert s.groupBy("id_item").count().where("count > 1").count() == 0
    views = pipeline.run_silver(spark, warehouse, as_views=True)
    assert spark.table("stg_rotas").count() == views["stg_rotas"].count() == 25
