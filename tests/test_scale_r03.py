"""Findings of round 3: flags without staging, loads without a join of whole rows, models without a needless window."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from curdle.operators import dedup, materialize
from curdle.plans import bronze, bronze_queries, ingest, silver
from curdle.plans.bronze import fixture_bronze, fixture_firsts, fixture_flags
from curdle.plans.operator_queries import o03_inner_join
from curdle.plans.quality_rules import RULES
from curdle.plans.queries import silver_for
from curdle.plans.silver import latest_rows
from curdle.session import apply_runtime_tuning
from curdle.sources.csv import CORRUPT
from curdle.sources.fixtures import fixture_loads, table_loads
from curdle.sources.manifest import BRONZE_TABLES, spec_for_file
from curdle.sources.store import Store


def _hex(i):
    return f"{i:032x}"


def test_flag_copies_equals_flag_duplicates(spark, monkeypatch):
    """A hot hash in several loads, with copies in more than one block."""
    monkeypatch.setattr(dedup, "COPIES", 7)
    rows = [(_hex(0), 1, i) for i in range(30)] + [(_hex(0), 2, i) for i in range(7)] + [(_hex(1), 2, 50), (_hex(2), 0, 51), (_hex(2), 0, 52), (_hex(2), 1, 53)]
    df = spark.createDataFrame(rows, "_row_hash string, load int, _row_id int")
    cols = ["_row_hash", "load", "_is_duplicate"]
    want = sorted(map(tuple, dedup.flag_duplicates(df, ["load", "_row_id"]).select(*cols).collect()))
    out = dedup.flag_copies(df.drop("_row_id"), "load", 3)
    assert sorted(map(tuple, out.select(*cols).collect())) == want
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("table", ["pedidos", "coletas", "rotas"])
def test_fixture_flags_equal_the_flagged_bronze_and_write_nothing(spark, table):
    before = len(materialize._STAGED)
    flags = fixture_flags(spark, SF_SMALL, table)
    got = sorted(map(tuple, flags.collect()))
    assert len(materialize._STAGED) == before
    assert got == sorted(map(tuple, fixture_bronze(spark, SF_SMALL, table).select(*flags.columns).collect()))


@pytest.mark.parametrize("table", BRONZE_TABLES)
def test_table_loads_are_those_of_the_rows(spark, table):
    found = [(r[0], spec.file) for spec, raw in fixture_loads(spark, SF_SMALL, table) for r in raw.select("_batch").distinct().collect()]
    assert sorted(found) == sorted((run, s.file) for run, s in table_loads(table))


@pytest.mark.parametrize("table,key", [("itens_pedido", "id_item"), ("pedidos", "id_pedido")])
def test_newest_rows_are_those_of_the_flagged_bronze(spark, table, key):
    rows = fixture_firsts(spark, SF_SMALL, table)
    assert ("Window" in rows._jdf.queryExecution().optimizedPlan().toString()) == (len(table_loads(table)) > 1)
    cols = [key, "_batch_id", "_row_hash"]
    want = latest_rows(fixture_bronze(spark, SF_SMALL, table), key).select(*cols)
    assert sorted(map(tuple, latest_rows(rows, key).select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_inner_join_query_stages_nothing(spark):
    before = len(materialize._STAGED)
    assert o03_inner_join(spark, SF_SMALL).count() > 0
    assert len(materialize._STAGED) == before


def test_a_load_without_repeats_joins_no_rows(spark, scratch, monkeypatch):
    spec = spec_for_file("rotas.csv")

    def load(run, ids):
        rows = spark.createDataFrame([(str(i), "r") for i in ids], "id_rota string, nome_rota string").withColumn(CORRUPT, F.lit(None).cast("string"))
        return ingest.load_rows(spark, rows, spec, scratch, run)

    joined = []
    mark = ingest.mark_repeats
    monkeypatch.setattr(ingest, "mark_repeats", lambda *a: joined.append(1) or mark(*a))
    assert load(1, [1, 2, 3])["rows_skipped"] == 0 and load(2, [4, 5])["rows_skipped"] == 0
    assert not joined
    row = load(3, [3, 6, 6, 4])
    assert (row["rows_skipped"], row["rows_inserted"]) == (3, 1) and joined
    got = sorted((r["_batch_id"], r["id_rota"], r["_is_duplicate"]) for r in ingest.read_bronze(spark, scratch, "rotas").collect())
    assert got == [(1, "1", False), (1, "2", False), (1, "3", False), (2, "4", False), (2, "5", False), (3, "3", True), (3, "4", True), (3, "6", False), (3, "6", True)]


def test_rows_without_repeats_are_written_once(spark, scratch, monkeypatch):
    """b07_ingestion_log: all rows were staged, then written again."""
    spec, again = spec_for_file("rotas.csv"), []
    write = ingest._Attempt._write_rows
    monkeypatch.setattr(ingest._Attempt, "_write_rows", lambda self, rows: again.append(self.load[0]) or write(self, rows))

    def load(run, ids):
        raw = spark.createDataFrame([(str(i), "r", None) for i in ids], f"id_rota string, nome_rota string, {CORRUPT} string")
        row = ingest.load_rows(spark, raw, spec, scratch, run)
        assert row["status"] == "SUCCESS", row
        folder = os.path.join(scratch, "bronze", "rotas")
        return row["rows_skipped"], [x for x in sorted(os.listdir(folder)) if x.startswith("rows-")]

    skipped, first = load(1, [1, 2, 3])
    assert skipped == 0 and not again and len(first) == 1
    assert all(".zstd." in f for f in os.listdir(os.path.join(scratch, "bronze", "rotas", first[0])) if f.startswith("part-"))
    skipped, second = load(2, [4, 4, 1])
    assert skipped == 2 and again == [2] and len(second) == 2
    got = sorted((r["_batch_id"], r["id_rota"], r["nome_rota"], r["_source_file"], r["_is_duplicate"]) for r in ingest.read_bronze(spark, scratch, "rotas").collect())
    assert got == [(1, i, "r", "rotas.csv", False) for i in "123"] + [(2, "1", "r", "rotas.csv", True), (2, "4", "r", "rotas.csv", False), (2, "4", "r", "rotas.csv", True)]


def test_the_ingestion_log_leaves_no_tables(spark, monkeypatch):
    """b07_ingestion_log: the warehouse that only the log is read from stayed on disk."""
    dropped, drop = [], Store.drop
    monkeypatch.setattr(Store, "drop", lambda self, layer, table: dropped.append((layer, table)) or drop(self, layer, table))
    homes = []
    real = bronze_queries.scratch_path
    monkeypatch.setattr(bronze_queries, "scratch_path", lambda *a: homes.append(real(*a)) or homes[-1])
    known = {d.name for d in spark.catalog.listDatabases()}
    log = bronze_queries.b07_ingestion_log(spark, SF_SMALL)
    assert [os.path.exists(h.removeprefix("file:")) for h in homes] == [False]
    assert {d.name for d in spark.catalog.listDatabases()} == known
    assert sorted(dropped) == sorted((layer, t) for layer in ("bronze", "bronze_keys") for t in BRONZE_TABLES)
    rows = log.collect()
    assert len(rows) > len(BRONZE_TABLES) and {r.status for r in rows} == {"SUCCESS"}


def _bronze(spark, parts):
    """Bronze rows of own raw rows: (file, run, schema, rows) a load."""
    out = None
    for file, run, schema, rows in parts:
        spec = spec_for_file(file)
        raw = bronze.normalize_rows(spark.createDataFrame(rows, schema), spec)
        load = bronze.stamp(raw, spec, bronze.fixture_ingested_at(F.lit(run), spec), F.lit(run))
        out = load if out is None else out.unionByName(load, allowMissingColumns=True)
    return bronze._by_content(out).withColumn("_is_duplicate", F.lit(False))


def _items(spark):
    columns = ["id_item", "id_pedido", "id_produto", "quantidade", "preco_unitario", "valor_total"]
    rows = [("1", "7", "3", "2", "1.5", ""), ("1", "8", "4", "2", "1.5", None), ("1", None, "9", "5", "2.5", "1"), (None, "7", "3", "2", "1.5", ""), (None, "9", "3", "2", "1.5", "")]
    rows += [("01", "7", "3", "2", "1.5", ""), ("2", "7", "3", "2", "1.5", ""), ("2", "7", "3", "2", "1.5", "")]
    return _bronze(spark, [("itens_pedido.csv", 1, ", ".join(f"{c} string" for c in columns), rows)])


def _collections(spark):
    layouts = {"a": ("coletas_fonte_a.csv", 1, 0), "b": ("coletas_fonte_b.csv", 1, 1), "c": ("coletas_fonte_c.csv", 2, 2)}
    keys = {"a": ["1", "2", "3", None], "b": ["2", "4", None], "c": ["3", "4", "5", "5"]}
    parts = []
    for name, (file, run, place) in layouts.items():
        columns = [names[place] for names in silver.COLLECTION_FIELDS.values()]
        rows = [(k, f"{place}{i}", "1", "2024-01-02" if i else " 2024-01-03 ", "5", "2", "1", "3", "3") for i, k in enumerate(keys[name])]
        if name == "c":
            columns, rows = [*columns, "c_observacao"], [(*r, "") for r in rows]
        parts.append((file, run, ", ".join(f"{c} string" for c in columns), rows))
    return _bronze(spark, parts)


@pytest.mark.parametrize("model,rows", [("stg_itens_pedido", _items), ("stg_coletas", _collections)])
def test_newest_rows_column_by_column_are_the_newest_rows(spark, model, rows):
    build = silver.SILVER_MODELS[model][1]
    want, got = (build(rows(spark), narrow=narrow, keyed=True) for narrow in (False, True))
    assert want.columns == got.columns and want.count() > 3
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_keys_alone_ask_for_no_content_hash(spark):
    """q02_unique reads keys: neither the text of other columns nor its MD5 is derived where a table has one load."""
    rules = [r for r in RULES if r.test == "unique"]
    for model, df in silver_for(spark, SF_SMALL, rules).items():
        plan = df.select(silver.MODEL_KEYS.get(model, "id_coleta"))._jdf.queryExecution().optimizedPlan().toString()
        assert ("md5(" in plan) == (len(table_loads(silver.SILVER_MODELS[model][0])) > 1), model


def test_dates_are_stripped_once(spark):
    """q01_not_null and the other model queries: the strip stands in a projection of its own, read by the rule."""
    raw = spark.createDataFrame([(" 2024-01-02\u2003",), ("3/4/2024",), ("",), (None,), ("x",)], "data_producao string").repartition(2)
    df = bronze.normalize_dates(raw, spec_for_file("producao.csv"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("trim(") == 1
    assert sorted(str(r[0]) for r in df.collect()) == ["2024-01-02", "2024-04-03", "None", "None", "None"]


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, scratch):
    """They were left to the driver's garbage collector, so a chain of staged steps held those of all its steps."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: tracker.shuffleStatuses().size()
    apply_runtime_tuning(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before = held()
    staged, path = materialize.stage(rows, "shuffled")
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.1)  # they are removed behind the query's end
    assert held() <= before
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, rows.collect())) == sorted(map(tuple, staged.collect()))
    materialize.discard(spark, path)


def test_staging_has_shuffle_files_removed_whoever_calls(spark, scratch):
    """pipeline: its stages are also called one by one, on a session that nobody has set up."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(key, "false")
    try:
        _, path = materialize.stage(spark.range(3), "any")
        materialize.discard(spark, path)
        assert spark.conf.get(key) == "true"
    finally:
        apply_runtime_tuning(spark)
