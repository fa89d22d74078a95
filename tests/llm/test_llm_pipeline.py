"""The pipeline's stages, each on its own input, and the registered queries."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_stage_drops_the_bad_only(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    seen = [r.doc_id for r in stages[0].collect() if r.doc_id in labels]
    assert sum((i in kept) == bool(labels[i]) for i in seen) >= 0.97 * len(seen)


def test_line_stage_equals_brute_force(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    gone, want = brute.removed_lines(rows), {}
    for i, t in rows:
        left = [line for k, line in enumerate(t.split("\n")) if k not in gone[i]]
        if not gone[i] or any(brute.words(line) for line in left):
            want[i] = "\n".join(left)
    got = {r.doc_id: r for r in stages[2].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_join_stage_keeps_one_of_each_class(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c for _, c, _ in brute.classes(rows)})


def test_mixing_stage_keeps_every_document(stages):
    assert {tuple(r) for r in stages[4].collect()} == {tuple(r) for r in stages[3].collect()}


def test_last_stage_encodes_every_drawn_document(stages):
    assert sorted(r.doc_id for r in stages[5].collect()) == sorted(r.doc_id for r in stages[4].collect())


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[5].collect()))


def test_odd_rows_pass_through(spark):
    rows = [(1, None, None, None, None), (None, "text without id " * 9, "en", "s", 3), (2, "", "en", None, 0), (3, "a b c d e f g", "en", "s", 9), (3, "a b c d e f g", "en", "s", 9)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, SF)
        assert len(docs.collect()) == (4 if some else 0)


def test_join_stage_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(3, "a b c", "en", "s", 5)] * 2 + [(4, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.one_of_each_class(spark, docs, SF).collect()] == [3]


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_join_stage_keeps_one_of_each_class_where_ids_clash(spark):
    """An id with two texts is in two classes; each class keeps one document."""
    a, b, c = ("one two three four five six seven eight nine ten " * 3, "red orange yellow green blue indigo violet black white grey " * 3, "lone text of its own kind here")
    rows = [(1, b), (5, b), (5, a), (7, a), (5, c), (5, c), (5, None), (5, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text or repr(r.text)) for r in corpus_pipeline.one_of_each_class(spark, df, "").collect())
    assert got == sorted([(1, b), (5, a), (5, c), (5, "None"), (5, "''")])
