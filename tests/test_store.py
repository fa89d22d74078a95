"""Loads and rebuilds as one step: faults at every step, sessions that attach, readers during a rebuild, stored hashes."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from curdle.plans import ingest, pipeline
from curdle.plans.ingest import load_file, load_rows, read_bronze, read_keys, read_log, read_quarantine, schema_history
from curdle.plans.silver import stg_rotas
from curdle.sources import catalog, files
from curdle.sources.csv import CORRUPT
from curdle.sources.manifest import spec_for_file
from curdle.sources.store import Store

ROTAS = "id_rota,nome_rota,municipio_origem,km_total,veiculo_tipo,ativa"
SPEC = spec_for_file("rotas.csv")


def load(spark, scratch, wh, run, ids, extra=""):
    folder = os.path.join(scratch, f"raw{run}-{random.random()}")
    os.makedirs(folder)
    with open(os.path.join(folder, "rotas.csv"), "w") as f:
        f.write(ROTAS + "\n" + "".join(f"{i},R{i},T,1.0,x,sim\n" for i in ids) + extra)
    return load_file(spark, folder, SPEC, wh, run)


def state(spark, wh):
    """All that a load may touch."""
    def rows(df):
        return None if df is None else sorted(map(repr, df.collect()))

    return rows(read_bronze(spark, wh, "rotas")), rows(read_keys(spark, wh, "rotas")), rows(read_quarantine(spark, wh))


STEPS = ["check_order", "write", "_define", "_rows", "_write_rows", "_reflag", "_quarantine"]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two runs; run 2 brings copies of run 1 and a row that cannot load."""
    root = str(tmp_path_factory.mktemp("store"))
    wh = os.path.join(root, "wh")
    load(spark, root, wh, 1, [1, 2], "9,a,b,c,d,e,f\n")
    load(spark, root, wh, 2, [1, 2, 2, 3], "8,a,b,c,d,e,f\n")
    return root, wh, state(spark, wh)


@pytest.mark.parametrize("step", [*STEPS, "second switch", "last switch", "journal", "log"])
def test_a_fault_at_any_step_leaves_the_earlier_rows(spark, loaded, monkeypatch, step):
    """Run 1 is loaded again without row 1, which also changes the flags of run 2."""
    root, wh, before = loaded

    def broken(*_, **__):
        raise OSError("injected")

    if step in STEPS:
        after = getattr(ingest._Attempt, step)

        def late(self, *a, **k):
            after(self, *a, **k)
            broken()

        monkeypatch.setattr(ingest._Attempt, step, late)
    elif step.endswith("switch"):
        real, seen = Store._switch, []

        def nth(self, change):
            seen.append(change)
            if len(seen) == (2 if step == "second switch" else 4):
                broken()
            real(self, change)

        monkeypatch.setattr(Store, "_switch", nth)
    elif step == "journal":
        real = Store._note
        monkeypatch.setattr(Store, "_note", lambda self, entries: broken() if any("location" in e for e in entries) else real(self, entries))
    else:
        real = ingest.append_log
        monkeypatch.setattr(ingest, "append_log", lambda s, w, row: broken() if row["status"] == "SUCCESS" else real(s, w, row))
    row = load(spark, root, wh, 1, [2, 5], "7,a,b,c,d,e,f\n")
    assert (row["status"], row["error_msg"]) == ("ERROR", "injected")
    assert state(spark, wh) == before
    monkeypatch.undo()
    if step in ("last switch", "journal", "log"):  # what a new session would find
        assert state(attached(spark, wh), wh) == before
    assert read_log(spark, wh).where("status = 'ERROR'").count() >= 1


def attached(spark, wh):
    """This session without what its catalog knows of the warehouse."""
    store = Store(spark, wh)
    for layer in ("bronze", "bronze_keys", "silver", "gold"):
        for t in catalog.list_tables(spark, store.database(layer)):
            spark.sql(f"DROP TABLE {store.name(layer, t)}")  # tables have locations of their own: files stay
    return spark


def test_a_new_session_attaches_the_last_commit(spark, scratch):
    wh = os.path.join(scratch, "wh")
    load(spark, scratch, wh, 1, [1, 2, 3], "9,a,b,c,d,e,f\n")
    load(spark, scratch, wh, 2, [2, 4])
    load(spark, scratch, wh, 1, [3])
    want = state(spark, wh)
    assert state(attached(spark, wh), wh) == want
    # and goes on from there
    load(spark, scratch, wh, 1, [])
    flags = {(r._batch_id, r.id_rota): r._is_duplicate for r in read_bronze(attached(spark, wh), wh, "rotas").collect()}
    assert flags == {(2, "2"): False, (2, "4"): False}
    assert read_quarantine(spark, wh).count() == 0
    store = Store(spark, wh)
    assert store.vacuum("bronze", "rotas") > 0
    assert {(r._batch_id, r.id_rota) for r in read_bronze(spark, wh, "rotas").collect()} == {(2, "2"), (2, "4")}


def plain_flags(runs):
    """{run: flags} of rows in order, by the rule alone."""
    out = {}
    for run, rows in runs.items():
        earlier = {x for r, rs in runs.items() if r < run for x in rs}
        out[run] = [x in earlier or x in rows[:i] for i, x in enumerate(rows)]
    return out


def test_flags_equal_the_rule_after_any_order_of_loads(spark, scratch):
    rng, wh, runs = random.Random(4), os.path.join(scratch, "wh"), {}
    for _ in range(7):
        run = rng.randint(1, 3)
        runs[run] = [rng.randint(1, 6) for _ in range(rng.randint(0, 6))]
        row = load(spark, scratch, wh, run, runs[run])
        assert row["status"] == "SUCCESS" and row["rows_skipped"] == sum(plain_flags(runs)[run])
        bronze = read_bronze(spark, wh, "rotas")
        got = {}
        for r in [] if bronze is None else bronze.orderBy("_batch_id", "_row_id").collect():
            got.setdefault(r._batch_id, []).append((int(r.id_rota), r._is_duplicate))
        assert got == {k: list(zip(v, plain_flags(runs)[k])) for k, v in runs.items() if v}


def test_stored_hashes_are_compared_bucket_to_bucket(spark, scratch):
    """No exchange above the scan of the side table, and no scan of the rows."""
    wh = os.path.join(scratch, "wh")
    load(spark, scratch, wh, 1, [1, 2])
    load(spark, scratch, wh, 2, [2, 3])
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k in keep:
            spark.conf.set(k, "false" if k.endswith("enabled") else "-1")
        keys = read_keys(spark, wh, "rotas")
        own = keys.where("_batch_id = 2").select("_row_hash", "_row_id")
        plan = own.join(keys.where(ingest._before(SPEC, (2, "rotas.csv"))).select("_row_hash"), "_row_hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert plan.count("keys-") == 2 and "rows-" not in plan  # each side lists its own load's folder alone


def test_a_column_belongs_to_the_load_that_brought_it(spark, scratch):
    wh, spec = os.path.join(scratch, "wh"), spec_for_file("clientes.csv")
    for run, columns in ((1, ["id_cliente"]), (2, ["id_cliente", "Cidade"]), (3, ["cidade", "id_cliente", "x y"])):
        rows = spark.createDataFrame([tuple(f"{run}{c}" for c in columns)], columns).withColumn(CORRUPT, F.lit(None).cast("string"))
        assert load_rows(spark, rows, spec, wh, run)["status"] == "SUCCESS"
    history = {r.column_name: r.added_by for r in schema_history(spark, wh, "clientes").collect() if r.added_by}
    assert history == {"id_cliente": "run 1, clientes.csv", "Cidade": "run 2, clientes.csv", "x y": "run 3, clientes.csv"}
    for s in (spark, attached(spark, wh)):
        assert sorted((r.id_cliente, r.Cidade, r["x y"]) for r in read_bronze(s, wh, "clientes").collect()) == [
            ("1id_cliente", None, None), ("2id_cliente", "2Cidade", None), ("3id_cliente", "3cidade", "3x y")
        ]
        assert {r.column_name: r.added_by for r in schema_history(s, wh, "clientes").collect() if r.added_by} == history


def test_a_reader_never_misses_a_table_that_is_rebuilt(spark, scratch):
    wh = os.path.join(scratch, "wh")
    load(spark, scratch, wh, 1, [1, 2])
    pipeline.run_silver(spark, wh)
    faults, sizes, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            try:
                sizes.add(pipeline.read_model(spark, wh, "silver", "stg_rotas").count())
            except Exception as e:  # noqa: BLE001
                faults.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for run in (2, 3, 4):
            load(spark, scratch, wh, run, list(range(run + 1)))
            pipeline.run_silver(spark, wh)
    finally:
        stop.set()
        reader.join()
    assert not faults and sizes <= {2, 3, 4, 5}
    assert pipeline.read_model(spark, wh, "silver", "stg_rotas").count() == 5
    # a failed rebuild leaves the version before
    with pytest.raises(Exception):
        Store(spark, wh).write_table(stg_rotas(read_bronze(spark, wh, "rotas")).withColumn("ativo", F.raise_error(F.lit("x")).cast("boolean")), "silver", "stg_rotas")
    assert pipeline.read_model(spark, wh, "silver", "stg_rotas").count() == 5


def test_a_model_may_be_placed_in_another_layer(spark, scratch, monkeypatch):
    wh = os.path.join(scratch, "wh")
    load(spark, scratch, wh, 1, [1])
    monkeypatch.setitem(pipeline.MODEL_LAYERS, "stg_rotas", " curated ")
    pipeline.run_silver(spark, wh)
    assert files.exists(spark, os.path.join(wh, "curated", "stg_rotas")) and not files.exists(spark, os.path.join(wh, "silver", "stg_rotas"))
    assert pipeline.read_model(spark, wh, "silver", "stg_rotas").count() == 1
