"""Delimited scan, per-file load, ingestion log, catalog — with real files on disk."""

import os

from pyspark.sql import functions as F

from curdle.plans.ingest import load_file, read_bronze, read_log, read_quarantine
from curdle.sources import catalog
from curdle.sources.store import Store
from curdle.sources.csv import judge_rows, read_delimited
from curdle.sources.manifest import spec_for_file


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_scan_semantics(spark, scratch):
    p = os.path.join(scratch, "t.csv")
    write(p, 'a;b;c\n1;;x\n2;"";y\n3;only\n4;p;q;r\n5;"1,5";z\n6;p;q;\n7\n8;"open;z\n9;;\n')
    raw = read_delimited(spark, p, ";")
    rows = {r.a: (r.b, r.c) for r in judge_rows(raw, ";").collect() if not r._quarantined}
    # empty field = '', quoted comma kept, missing field = null
    assert rows == {"1": ("", "x"), "2": ("", "y"), "3": ("only", None), "5": ("1,5", "z"), "7": (None, None)}
    # a quote that never closes takes the rest of the file with it
    assert sorted(r._quarantined for r in judge_rows(raw, ";").collect() if r._quarantined) == ['4;p;q;r', '6;p;q;', '8;"open;z', '9;;']
    wide = {r.a: (r.b, r.c) for r in judge_rows(raw, ";", keep_surplus=True).collect() if not r._quarantined}
    assert wide == rows | {"4": ("p", "q"), "6": ("p", "q")}
    assert read_delimited(spark, os.path.join(scratch, "missing.csv")) is None


def test_load_is_idempotent_and_second_copy_is_flagged(spark, scratch):
    raw_dir, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    write(
        os.path.join(raw_dir, "pedidos.csv"),
        "id_pedido,id_cliente,data_pedido,status,canal,desconto_pct\n"
        "1,10,05/01/2024,Faturado,Direto,\n2,11,2024-01-06,Cancelado,Direto,5\n2,11,2024-01-06,Cancelado,Direto,5\n"
        "3,12, 1/2/24 ,x,y,z\n4,13\n5,1,2,3,4,5,6\n",
    )
    spec = spec_for_file("pedidos.csv")
    row = load_file(spark, raw_dir, spec, wh, 1)
    assert row["status"] == "SUCCESS"
    assert (row["rows_read"], row["rows_inserted"], row["rows_skipped"], row["rows_quarantined"]) == (5, 4, 1, 1)
    assert row["rows_read"] == row["rows_inserted"] + row["rows_skipped"]
    # re-running the same load replaces its own partition: same table
    again = load_file(spark, raw_dir, spec, wh, 1)
    assert (again["rows_inserted"], again["rows_skipped"]) == (4, 1)
    assert read_bronze(spark, wh, "pedidos").count() == 5
    assert [(r.raw_line, r._batch_id, r._source_file) for r in read_quarantine(spark, wh).collect()] == [("5,1,2,3,4,5,6", 1, "pedidos.csv")]
    # the same file in a later run inserts nothing
    later = load_file(spark, raw_dir, spec, wh, 2)
    assert (later["rows_read"], later["rows_inserted"], later["rows_skipped"]) == (5, 0, 5)
    bronze = read_bronze(spark, wh, "pedidos")
    dates = {r.id_pedido: r.data_pedido for r in bronze.where("_batch_id = 1").collect()}
    assert dates["1"] == "2024-01-05" and dates["3"] == "24-02-01"  # bronze date normalisation
    log = read_log(spark, wh).collect()
    assert [r.status for r in log] == ["SUCCESS"] * 3
    assert [r.rows_updated for r in log] == [0, 0, 0]
    assert log[0].ingested_at <= log[-1].ingested_at


ROTAS = "id_rota,nome_rota,municipio_origem,km_total,veiculo_tipo,ativa\n"


def _load(spark, scratch, run, ids, wh):
    folder = os.path.join(scratch, f"run{run}-{len(ids)}")
    write(os.path.join(folder, "rotas.csv"), ROTAS + "".join(f"{i},R{i},T,1.0,x,sim\n" for i in ids))
    return load_file(spark, folder, spec_for_file("rotas.csv"), wh, run)


def _silver(spark, wh):
    from curdle.plans.silver import stg_rotas

    return sorted(r.id_rota for r in stg_rotas(read_bronze(spark, wh, "rotas")).collect())


def test_rerun_of_an_older_run_keeps_silver(spark, scratch):
    from curdle.plans.pipeline import compact_bronze

    wh = os.path.join(scratch, "wh")
    _load(spark, scratch, 1, [1, 2], wh)
    _load(spark, scratch, 2, [1, 2, 3], wh)
    assert _silver(spark, wh) == [1, 2, 3]
    assert _load(spark, scratch, 1, [1, 2], wh)["rows_skipped"] == 0
    assert _silver(spark, wh) == [1, 2, 3]
    # A corrected older run: what it no longer holds is first in the later run now.
    _load(spark, scratch, 1, [2], wh)
    flags = {(r._batch_id, r.id_rota): r._is_duplicate for r in read_bronze(spark, wh, "rotas").collect()}
    assert flags == {(1, "2"): False, (2, "1"): False, (2, "2"): True, (2, "3"): False}
    assert compact_bronze(spark, wh, "rotas") == 1
    assert _silver(spark, wh) == [1, 2, 3]
    # The copy that run 1 would take back is gone, so it cannot be loaded again; a later run can.
    row = _load(spark, scratch, 1, [], wh)
    assert row["status"] == "ERROR" and "compacted" in row["error_msg"]
    assert _load(spark, scratch, 3, [1, 4], wh)["rows_skipped"] == 1
    assert _silver(spark, wh) == [1, 2, 3, 4]


def test_header_only_file_loads_nothing(spark, scratch):
    wh = os.path.join(scratch, "wh")
    row = _load(spark, scratch, 1, [], wh)
    assert (row["status"], row["rows_read"], row["rows_inserted"], row["rows_skipped"]) == ("SUCCESS", 0, 0, 0)
    assert read_bronze(spark, wh, "rotas") is None
    _load(spark, scratch, 1, [1, 2], wh)
    assert read_bronze(spark, wh, "rotas").count() == 2
    assert _load(spark, scratch, 1, [], wh)["rows_read"] == 0
    assert read_bronze(spark, wh, "rotas") is None  # the re-run replaced the load's rows by none


def test_failed_load_is_logged_and_missing_file_skipped(spark, scratch, monkeypatch):
    wh = os.path.join(scratch, "wh")
    assert load_file(spark, scratch, spec_for_file("rotas.csv"), wh, 1) is None

    def broken(*_):
        raise ValueError("x" * 5000)

    monkeypatch.setattr("curdle.plans.ingest.normalize_rows", broken)
    row = _load(spark, scratch, 1, [1], wh)
    assert (row["status"], row["rows_read"], row["error_msg"]) == ("ERROR", None, "x" * 5000)
    logged = read_log(spark, wh).collect()
    assert [(r.status, r.error_msg, r.rows_read) for r in logged] == [("ERROR", "x" * 5000, None)]


def test_load_time_is_the_same_instant_in_any_zone(spark, scratch):
    import datetime as dt
    import time

    wh = os.path.join(scratch, "wh")
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/Sao_Paulo"
    time.tzset()
    try:
        _load(spark, scratch, 1, [1], wh)
        seconds = read_bronze(spark, wh, "rotas").select(F.unix_timestamp("_ingested_at")).first()[0]
    finally:
        os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
        time.tzset()
    assert abs(seconds - dt.datetime.now(dt.timezone.utc).timestamp()) < 300


def test_catalog_layers_and_listing(spark, scratch):
    assert catalog.layer_for(None) == "public"
    assert catalog.layer_for("silver") == "silver"
    store = Store(spark, os.path.join(scratch, "wh"))
    gold = catalog.ensure_layers(spark, store.warehouse)[2]
    for name in ("zeta", "alpha"):
        store.write_table(spark.range(3), "gold", name)
    assert catalog.list_tables(spark, gold) == ["alpha", "zeta"]
    assert catalog.read(spark, gold, "alpha").agg(F.sum("id")).first()[0] == 3


def test_warehouses_of_one_catalog_keep_apart(spark, scratch):
    one, two = (Store(spark, os.path.join(scratch, n)) for n in ("wh1", "wh2"))
    assert one.database("silver") != two.database("silver") and one.database("silver") == Store(spark, one.warehouse + "/").database("silver")
    one.write_table(spark.range(3), "silver", "t")
    assert not two.exists("silver", "t")


def test_schema_evolution_across_loads(spark, scratch):
    raw1, raw2, wh = os.path.join(scratch, "r1"), os.path.join(scratch, "r2"), os.path.join(scratch, "wh")
    write(os.path.join(raw1, "clientes.csv"), "id_cliente,nome_cliente\n1,Ana\n")
    write(os.path.join(raw2, "clientes.csv"), "id_cliente,nome_cliente,cidade\n2,Bia,Rio\n")
    spec = spec_for_file("clientes.csv")
    assert load_file(spark, raw1, spec, wh, 1)["status"] == "SUCCESS"
    assert load_file(spark, raw2, spec, wh, 2)["status"] == "SUCCESS"
    got = {r.id_cliente: r.cidade for r in read_bronze(spark, wh, "clientes").collect()}
    assert got == {"1": None, "2": "Rio"}  # the later file's extra column; null for older rows


def test_compact_drops_only_flagged_rows(spark, scratch):
    from curdle.plans.pipeline import compact_bronze

    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    write(os.path.join(raw, "rotas.csv"), "id_rota,nome_rota\n1,A\n1,A\n2,B\n")
    spec = spec_for_file("rotas.csv")
    load_file(spark, raw, spec, wh, 1)
    load_file(spark, raw, spec, wh, 2)  # same file again: all flagged
    assert read_bronze(spark, wh, "rotas").count() == 6
    assert compact_bronze(spark, wh, "rotas") == 4
    left = read_bronze(spark, wh, "rotas")
    assert sorted((r.id_rota, r._batch_id) for r in left.collect()) == [("1", 1), ("2", 1)]
    assert left.where("_is_duplicate").count() == 0
