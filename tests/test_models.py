"""Silver / gold semantics on hand-written bronze rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from curdle.functions.hashing import row_hash
from curdle.plans import gold
from curdle.plans.silver import stg_itens_pedido, stg_pedidos, stg_producao

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def bronze(spark, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols) + ", _ingested_at timestamp, _is_duplicate boolean")
    df = df.withColumn("_batch_id", F.dayofmonth("_ingested_at").cast("bigint")).withColumn("_row_id", F.monotonically_increasing_id())
    return df.withColumn("_row_hash", row_hash(cols)).withColumn("_source_file", F.lit("f.csv"))


ORDER_COLS = ["id_pedido", "id_cliente", "data_pedido", "status", "canal", "desconto_pct"]


def test_orders_rule_reads_raw_date_and_latest_wins(spark):
    rows = [
        ("1", "10", "2024-01-05", "Faturado", "Direto", "", T0, False),
        ("1", "10", "2024-01-05", "Cancelado", "Direto", "", T1, False),  # newer version wins
        ("2", "11", "24-02-01", " entregue", "x", "5", T0, False),  # odd text: parsed null, rule still true
        ("3", "12", "2024-01-07", "Faturado", "x", "", T1, True),  # flagged copy: ignored
    ]
    s = {r.id_pedido: r for r in stg_pedidos(bronze(spark, rows, ORDER_COLS)).collect()}
    assert set(s) == {1, 2}
    assert s[1].status == "CANCELADO" and s[1].desconto_pct is None
    assert s[2].data_pedido is None and s[2]._dq_ok is True and s[2].status == "ENTREGUE"


def test_last_row_of_the_last_run_wins(spark):
    rows = [("7", "1", "2024-01-01", s, "c", "", T0, False) for s in ("A", "Z", "B")]
    b = bronze(spark, rows, ORDER_COLS)
    assert {stg_pedidos(b.repartition(n)).first().status for n in (1, 2, 3)} == {"B"}
    # Never by the clock: run 1 loaded again, later than run 2, stays before it.
    again = b.withColumn("_batch_id", F.lit(1).cast("bigint")).withColumn("_ingested_at", F.lit(T1))
    newer = bronze(spark, [("7", "1", "2024-01-01", "run 2", "c", "", T0, False)], ORDER_COLS).withColumn("_batch_id", F.lit(2).cast("bigint"))
    assert stg_pedidos(again.unionByName(newer)).first().status == "RUN 2"


def test_discount_keeps_all_decimals(spark):
    pedidos = spark.createDataFrame(
        [(i, dt.date(2024, 1, 5), "FATURADO", D("0.0333"), True) for i in range(3)],
        "id_pedido long, data_pedido date, status string, desconto_pct decimal(18,4), _dq_ok boolean",
    )
    itens = spark.createDataFrame([(i, D("0.0007"), True) for i in range(3)], "id_pedido long, valor_total decimal(18,4), _dq_ok boolean")
    r = gold.receita_mensal(pedidos, itens).first()
    assert r.desconto_total == D("0.0007") * D("0.0333") * 3 / 100
    assert r.receita_liquida == D("0.0021") - r.desconto_total


def test_strict_and_lenient_casts(spark):
    rows = [("1", "10", "2024-13-01", "x", "y", "", T0, False)]
    b = bronze(spark, rows, ORDER_COLS)
    with pytest.raises(PySparkException):
        stg_pedidos(b).collect()
    assert stg_pedidos(b, strict=False).first().data_pedido is None


def test_items_repair_and_impute(spark):
    cols = ["id_item", "id_pedido", "id_produto", "quantidade", "preco_unitario", "valor_total"]
    rows = [("11", "1", "5", "2", "-3.50", "", T0, False), ("12", "1", "5", "1", "4", "9.99", T0, False)]
    s = {r.id_item: r for r in stg_itens_pedido(bronze(spark, rows, cols)).collect()}
    assert float(s[11].preco_unitario) == 3.5 and float(s[11].valor_total) == 7.0
    assert s[11]._dq_preco_negativo and s[11]._dq_valor_total_imputado and s[11]._dq_ok is False
    assert float(s[12].valor_total) == 9.99 and s[12]._dq_ok


def test_production_line_and_yield(spark):
    cols = ["id_producao", "id_produto", "data_producao", "linha_producao", "volume_entrada_litros", "volume_saida",
            "custo_total", "lote", "validade"]
    rows = [("1", "2", "2024-01-01", "Linha  C  x", "300", "200", "", "L", "2024-06-01", T0, False),
            ("2", "2", "2024-01-01", "a", "0", "5", "1", "L", "", T0, False)]
    s = {r.id_producao: r for r in stg_producao(bronze(spark, rows, cols)).collect()}
    assert s[1].linha_producao == "LINHA C  X"  # only the first whitespace run collapses
    assert float(s[1].rendimento_pct) == 0.6667
    assert s[2].rendimento_pct is None and s[2]._dq_ok is False


def test_result_mart_null_month_and_missing_costs(spark):
    pedidos = spark.createDataFrame(
        [(1, dt.date(2024, 1, 5), "FATURADO", D("10"), True), (2, None, "FATURADO", None, True), (3, dt.date(2024, 1, 9), "CANCELADO", None, True)],
        "id_pedido long, data_pedido date, status string, desconto_pct decimal(18,4), _dq_ok boolean",
    )
    itens = spark.createDataFrame(
        [(1, D("100"), True), (1, D("50"), True), (2, D("30"), True), (3, D("99"), True)],
        "id_pedido long, valor_total decimal(18,4), _dq_ok boolean",
    )
    custos = spark.createDataFrame([], "valor decimal(18,4), tipo_custo string, centro_custo string, data_referencia date, _dq_ok boolean")
    perdas = spark.createDataFrame([(dt.date(2024, 1, 3), D("5"), True)], "data_perda date, valor_estimado decimal(18,4), _dq_ok boolean")
    entregas = spark.createDataFrame([], "data_realizada date, custo_frete decimal(18,4), _dq_ok boolean")
    got = {r.mes: r for r in gold.mart_resultado_mensal(pedidos, itens, custos, perdas, entregas).collect()}
    jan = got[dt.date(2024, 1, 1)]
    assert (jan.receita_bruta, jan.desconto_total, jan.receita_liquida, jan.qtd_pedidos) == (150.0, 15.0, 135.0, 1)
    assert (jan.valor_perdas, jan.custo_fixo, jan.resultado_estimado) == (5.0, 0.0, 130.0)
    assert got[None].receita_bruta == 30.0 and got[None].valor_perdas == 0.0  # null month never joins
