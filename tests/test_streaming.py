"""File-arrival ingestion: each new file is loaded once, through the bronze load path."""

import os

from curdle.plans.ingest import read_bronze, read_log
from curdle.sources.manifest import spec_for_file
from curdle.streaming.ingest import ingest_available


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_available_now_loads_new_files_once(spark, scratch):
    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    spec = spec_for_file("rotas.csv")
    header = "id_rota,nome_rota,municipio_origem,km_total,veiculo_tipo,ativa\n"
    write(os.path.join(raw, "rotas.csv", "part-1.csv"), header + "1,R1,T,10.0,Tanque,sim\n2,R2,T,20.0,Tanque,Não\n")
    assert ingest_available(spark, raw, [spec], wh) == 1
    assert read_bronze(spark, wh, "rotas").count() == 2
    # nothing new: the stream's checkpoint remembers the file
    ingest_available(spark, raw, [spec], wh)
    assert read_bronze(spark, wh, "rotas").count() == 2
    # a new file with one repeated row and one new row
    write(os.path.join(raw, "rotas.csv", "part-2.csv"), header + "1,R1,T,10.0,Tanque,sim\n3,R3,T,30.0,Tanque,sim\n")
    ingest_available(spark, raw, [spec], wh)
    bronze = read_bronze(spark, wh, "rotas")
    assert bronze.count() == 4
    assert bronze.where("_is_duplicate").count() == 1
    assert [r.status for r in read_log(spark, wh).collect()] == ["SUCCESS", "SUCCESS"]


def test_failed_micro_batch_is_taken_again(spark, scratch, monkeypatch):
    import pytest
    from pyspark.errors import StreamingQueryException

    from curdle.plans import ingest

    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    spec = spec_for_file("rotas.csv")
    write(os.path.join(raw, "rotas.csv", "part-1.csv"), "id_rota,nome_rota\n1,R1\n")

    def broken(*_):
        raise ValueError("injected")

    with monkeypatch.context() as m:
        m.setattr(ingest, "normalize_rows", broken)
        with pytest.raises(StreamingQueryException):
            ingest_available(spark, raw, [spec], wh)
    assert read_bronze(spark, wh, "rotas") is None
    ingest_available(spark, raw, [spec], wh)
    assert read_bronze(spark, wh, "rotas").count() == 1


def test_warehouses_do_not_share_progress(spark, scratch):
    raw = os.path.join(scratch, "raw")
    spec = spec_for_file("rotas.csv")
    write(os.path.join(raw, "rotas.csv", "part-1.csv"), "id_rota,nome_rota\n1,R1\n")
    for name in ("wh1", "wh2"):
        wh = os.path.join(scratch, name)
        ingest_available(spark, raw, [spec], wh)
        assert read_bronze(spark, wh, "rotas").count() == 1
