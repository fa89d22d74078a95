"""The driver contract: entry runs, every query has an oracle, and a sample agrees with DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from curdle.sources.tables import TEST_TABLES


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "margem_pct" in df.columns


def test_every_query_has_oracle_sql():
    core = {q for q in entry.queries() if q != "pipeline" and not q.startswith("op")}
    assert core == {q for q in entry.oracle_sql() if q != "pipeline" and not q.startswith("op")}
    assert len(core) == 52


def canon(v):
    if isinstance(v, float):
        return repr(v)
    return str(v) if v is not None else "NULL"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize(
    "key", ["b09_rerun_flags", "b10_malformed_rows", "b11_quoted_breaks", "b12_schema_versions", "b07_ingestion_log", "b05_flag_duplicates_in_batch", "s03_coletas", "g02_eficiencia_producao", "g05_resultado_mensal", "q05_suite_summary", "o13_regexp_replace_first"]
)
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(o_cols)
    order = sorted(o_cols)
    s_rows = sorted(tuple(canon(r[c]) for c in order) for r in sdf.collect())
    o_rows = sorted(tuple(canon(r[o_cols.index(c)]) for c in order) for r in res.fetchall())
    assert s_rows == o_rows
