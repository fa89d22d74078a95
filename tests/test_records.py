"""Quoted line breaks: records of split files against the standard library's reader, odd quotes, bounded joins."""

import csv
import os
import random

import pytest

from curdle.operators import materialize
from curdle.plans.ingest import load_file, read_bronze, read_quarantine
from curdle.sources import records
from curdle.sources.csv import judge_rows, read_delimited
from curdle.sources.manifest import spec_for_file


@pytest.fixture
def small_splits(spark):
    """Splits of some ninety bytes, so that records span several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rng):
    r = rng.random()
    if r < 0.3:
        return "x" * rng.randint(0, 6)
    if r < 0.5:
        return '"' + rng.choice(["a", "", 'b""c', '""', "p;q,r"]) + '"'
    if r < 0.8:
        return '"' + rng.choice(["l1\nl2", "\n", 'a""\n""b', 'x\n\ny,""\n,""\n', "q\r\nr", "long " * 40 + "\n" + "tail " * 40]) + '"'
    return rng.choice(['5" pipe', "é", 'in"side"', " "])


@pytest.mark.parametrize("seed,delimiter,end", [(1, ",", "\n"), (2, ";", "\n"), (3, ",", "\r\n")])
def test_records_of_split_files_equal_the_plain_reader(spark, scratch, small_splits, seed, delimiter, end):
    rng, want = random.Random(seed), []
    for k in range(2):
        with open(f"{scratch}/p{k}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(delimiter.join("abc") + end)
            for i in range(120):
                f.write(delimiter.join([str(k * 1000 + i), field(rng), field(rng)]) + end)
        with open(f"{scratch}/p{k}.csv", newline="", encoding="utf-8") as f:
            want += list(csv.reader(f, delimiter=delimiter))[1:]
    lines = records.physical_lines(spark, scratch)
    assert lines.select("file", "block").distinct().count() > 40
    got = judge_rows(read_delimited(spark, scratch, delimiter), delimiter).orderBy("_line").collect()
    assert [[r.a, r.b, r.c] for r in got] == want
    assert all(r._quarantined is None for r in got)


def test_a_quote_that_never_closes_loses_nothing(spark, scratch, small_splits):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,"x\ny"\n2,z\n3,"open\n' + "".join(f"{i},row\n" for i in range(4, 60)))
    got = judge_rows(read_delimited(spark, path)).orderBy("_line").collect()
    assert [(r.a, r.b) for r in got if r._quarantined is None] == [("1", "x\ny"), ("2", "z")]
    assert [r._quarantined for r in got if r._quarantined] == ['3,"open'] + [f"{i},row" for i in range(4, 60)]


def test_a_record_beyond_the_bound_is_set_apart_line_by_line(spark, scratch, small_splits):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('a,b\n1,"' + "long\n" * 50 + '"\n2,"x\ny"\n')
    found = records.logical_records(records.physical_lines(spark, path), longest=100).collect()
    assert sorted(r.record for r in found if r.record and not r.first) == ['2,"x\ny"']
    assert sum(r.lost is not None for r in found) == 51


def test_long_lines_do_not_exhaust_the_stack(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,\"" + '""x' * 200_000 + "\n" + "y" * 300_000 + '"\n' + "2," + '"q",' * 0 + '"' + '""' * 150_000 + '"\n')
    got = judge_rows(read_delimited(spark, path)).orderBy("_line").collect()
    assert [(r.a, len(r.b)) for r in got] == [("1", 2 * 200_000 + 1 + 300_000), ("2", 150_000)]


def test_a_quoted_break_loads_as_one_row(spark, scratch):
    raw, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw)
    with open(os.path.join(raw, "rotas.csv"), "w") as f:
        f.write('id_rota,nome_rota,municipio_origem,km_total,veiculo_tipo,ativa\n1,"Rota\num",x,10,t,sim\n2,R2,x,10,t,sim\n2,R2,x,10,t,sim\n3,"a",b,c,d,e,f\n')
    row = load_file(spark, raw, spec_for_file("rotas.csv"), wh, 1)
    assert (row["status"], row["rows_read"], row["rows_skipped"], row["rows_quarantined"]) == ("SUCCESS", 3, 1, 1)
    assert sorted((r.id_rota, r.nome_rota) for r in read_bronze(spark, wh, "rotas").collect()) == [("1", "Rota\num"), ("2", "R2"), ("2", "R2")]
    assert [r.raw_line for r in read_quarantine(spark, wh).collect()] == ['3,"a",b,c,d,e,f']


def test_lines_are_written_once_and_meet_their_split_without_moving(spark, scratch, small_splits):
    with open(f"{scratch}/p.csv", "w") as f:
        f.write("a,b\n" + "".join(f'{i},"x\n{i}"\n{i},y\n' for i in range(60)))
    before = len(materialize._STAGED)
    found = records.logical_records(records.physical_lines(spark, f"{scratch}/p.csv"))
    assert [os.path.basename(p).rsplit("-", 1)[0] for _, p in materialize._STAGED[before:]] == ["physical-lines", "splits"]
    assert "hashpartitioning(file" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.record for r in found.collect() if not r.first) == sorted([f'{i},"x\n{i}"' for i in range(60)] + [f"{i},y" for i in range(60)])
