"""Silver kept up by key equals a full build, whatever order loads come, return and go in."""

import os
import random

import pytest

from curdle.plans import pipeline
from curdle.plans.incremental import update_model
from curdle.plans.ingest import load_rows, read_bronze
from curdle.plans.silver import SILVER_MODELS, stg_rotas
from curdle.sources.csv import CORRUPT
from curdle.sources.manifest import spec_for_file
from curdle.sources.store import Store


def load(spark, wh, run, rows, file="rotas.csv"):
    columns = {"rotas.csv": ["id_rota", "nome_rota", "municipio_origem", "km_total", "veiculo_tipo", "ativa"]}[file]
    df = spark.createDataFrame([(k, name, "T", "1.0", "x", "sim") for k, name in rows], ", ".join(f"{c} string" for c in columns))
    assert load_rows(spark, df.coalesce(1).selectExpr("*", f"CAST(NULL AS string) AS {CORRUPT}"), spec_for_file(file), wh, run)["status"] == "SUCCESS"


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed", [1])
def test_incremental_equals_full_after_any_loads(spark, scratch, seed):
    """Later loads, re-runs, emptied loads, values that return, null keys and keys that differ as text only."""
    rng, wh, seen = random.Random(seed), os.path.join(scratch, "wh"), []
    for step in range(9):
        run = step + 1 if step < 4 or rng.random() < 0.3 else rng.randint(1, 4)
        new = [(rng.choice([None, "1", "2", "3", "03", "4", "5"]), rng.choice("ABA")) for _ in range(rng.randint(0, 5))]
        load(spark, wh, run, new)
        bronze = read_bronze(spark, wh, "rotas")
        if not Store(spark, wh).exists("bronze", "rotas"):
            continue
        seen.append(update_model(spark, wh, "stg_rotas", strict=False, buckets=3))
        got = pipeline.read_model(spark, wh, "silver", "stg_rotas")
        assert rows(got) == ([] if bronze is None else rows(stg_rotas(bronze, strict=False)))
    assert update_model(spark, wh, "stg_rotas") == "unchanged"
    assert seen[0] == "full" and {"later loads", "touched keys"} <= set(seen) and "full" not in seen[1:]


def test_only_buckets_of_touched_keys_are_written(spark, scratch):
    wh = os.path.join(scratch, "wh")
    load(spark, wh, 1, [(str(i), "A") for i in range(50)])
    assert update_model(spark, wh, "stg_rotas", buckets=8) == "full"
    store = Store(spark, wh)
    before = {x: store.location("silver", "stg_rotas", x) for x in store.loads("silver", "stg_rotas")}
    load(spark, wh, 2, [("7", "B")])
    assert update_model(spark, wh, "stg_rotas") == "later loads"
    after = {x: store.location("silver", "stg_rotas", x) for x in store.loads("silver", "stg_rotas")}
    assert len(before) == 8 and sum(before[x] != after[x] for x in before) == 1
    # A value that returns is a copy, so the model keeps the one between (as a full build does).
    load(spark, wh, 3, [("7", "A")])
    update_model(spark, wh, "stg_rotas")
    assert {r.id_rota: r.nome_rota for r in pipeline.read_model(spark, wh, "silver", "stg_rotas").collect()}[7] == "B"
    # Where the folders of a replaced load are gone, the model is built in full.
    load(spark, wh, 2, [("7", "C")])
    store.vacuum("bronze", "rotas")
    assert update_model(spark, wh, "stg_rotas") == "full"
    assert rows(pipeline.read_model(spark, wh, "silver", "stg_rotas")) == rows(stg_rotas(read_bronze(spark, wh, "rotas")))


def test_a_failed_update_leaves_the_model(spark, scratch, monkeypatch):
    wh = os.path.join(scratch, "wh")
    load(spark, wh, 1, [("1", "A"), ("2", "A")])
    assert pipeline.update_silver(spark, wh) == {"stg_rotas": "full"}
    load(spark, wh, 2, [("1", "B"), ("3", "B")])
    want, real, n = rows(pipeline.read_model(spark, wh, "silver", "stg_rotas")), Store._switch, []

    def second(self, change):
        n.append(change)
        if len(n) == 2:
            raise OSError("injected")
        real(self, change)

    with monkeypatch.context() as m:
        m.setattr(Store, "_switch", second)
        with pytest.raises(OSError):
            pipeline.update_silver(spark, wh)
    assert rows(pipeline.read_model(spark, wh, "silver", "stg_rotas")) == want
    assert pipeline.update_silver(spark, wh) == {"stg_rotas": "later loads"}
    full = rows(stg_rotas(read_bronze(spark, wh, "rotas")))
    assert rows(pipeline.read_model(spark, wh, "silver", "stg_rotas")) == full
    pipeline.run_silver(spark, wh)  # a full rebuild takes over, and back
    assert rows(pipeline.read_model(spark, wh, "silver", "stg_rotas")) == full
    assert pipeline.update_silver(spark, wh) == {"stg_rotas": "full"}


def test_every_model_has_its_key(spark):
    from curdle.plans.silver import MODEL_KEYS

    assert set(MODEL_KEYS) | {"stg_coletas"} == set(SILVER_MODELS)
