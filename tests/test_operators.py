"""Dedup, aggregation and data-quality operators on hand-written tables."""

from pyspark.sql import functions as F

from curdle.operators import quality
from curdle.operators.aggregates import count_when, reaggregate, share_of_period, sum_when
from curdle.operators.dedup import flag_against_existing, flag_duplicates, latest_by_key


def test_latest_by_key_newest_wins_and_null_key_collapses(spark):
    rows = [("k1", 1, "old"), ("k1", 2, "new"), ("k2", 1, "only"), (None, 1, "n1"), (None, 2, "n2")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = {(r.k, r.v) for r in latest_by_key(df, "k", [F.desc("t"), F.desc("v")]).collect()}
    assert got == {("k1", "new"), ("k2", "only"), (None, "n2")}


def test_latest_by_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_by_key(df, "k", [F.desc("t")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_flag_duplicates_hot_group(spark):
    # one content hash holds a third of the rows: every copy after the first is flagged
    hot = [("h0", 1, i) for i in range(300)]
    cold = [(f"h{i}", 1, i) for i in range(1, 601)]
    df = spark.createDataFrame(hot + cold, "_row_hash string, _batch int, _row_id int")
    out = flag_duplicates(df, ["_batch", "_row_id"])
    counts = {r["_row_hash"]: r["n"] for r in out.where("_is_duplicate").groupBy("_row_hash").agg(F.count("*").alias("n")).collect()}
    assert counts == {"h0": 299}
    assert out.count() == 900  # every row kept
    first = out.where("_row_hash = 'h0' AND NOT _is_duplicate").first()
    assert first["_row_id"] == 0


def test_flag_duplicates_earlier_batch_wins(spark):
    df = spark.createDataFrame([("a", 2, 0), ("a", 1, 5), ("b", 2, 1)], "_row_hash string, _batch int, _row_id int")
    got = {(r["_batch"], r["_is_duplicate"]) for r in flag_duplicates(df, ["_batch", "_row_id"]).where("_row_hash='a'").collect()}
    assert got == {(1, False), (2, True)}


def test_flag_against_existing(spark):
    batch = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("c", 3)], "_row_hash string, _row_id int")
    stored = spark.createDataFrame([("b",), ("b",), ("z",)], "_row_hash string")
    got = {(r["_row_hash"], r["_row_id"], r["_is_duplicate"]) for r in flag_against_existing(batch, stored, ["_row_id"]).collect()}
    assert got == {("a", 0, False), ("a", 1, True), ("b", 2, True), ("c", 3, False)}
    first_load = flag_against_existing(batch, None, ["_row_id"]).where("_is_duplicate").count()
    assert first_load == 1


def test_conditional_aggregates_and_share(spark):
    df = spark.createDataFrame(
        [("m1", "A", 10.0), ("m1", "B", 30.0), ("m2", "A", 5.0), ("m2", None, None)], "m string, t string, v double"
    )
    agg = df.groupBy("m").agg(
        sum_when(F.col("t") == "A", F.col("v")).alias("a"), count_when(F.col("t") == "B").alias("nb")
    )
    got = {r.m: (r.a, r.nb) for r in agg.collect()}
    assert got == {"m1": (10.0, 1), "m2": (5.0, 0)}
    per = df.groupBy("m", "t").agg(F.sum("v").alias("v"))
    shares = share_of_period(per, "v", "m", "tot").where("m = 'm1'").select("t", (F.col("v") / F.col("tot")).alias("s"))
    assert {r.t: r.s for r in shares.collect()} == {"A": 0.25, "B": 0.75}


def test_reaggregate_matches_direct_grouping(spark):
    fact = spark.createDataFrame([(1, "x", 2), (1, "x", 3), (2, "y", 4)], "k int, g string, v int")
    dim = spark.createDataFrame([(1, "n1"), (1, "n1"), (2, "n2")], "k int, name string")  # key 1 repeats
    direct = fact.join(dim, "k", "left").groupBy("k", "name").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    pre = fact.groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    two_step = reaggregate(pre.join(dim, "k", "left"), ["k", "name"], ["v", "n"])
    assert sorted(direct.collect()) == sorted(two_step.select("k", "name", "v", "n").collect())


def test_quality_tests(spark):
    child = spark.createDataFrame([(1, "A"), (2, "B"), (2, "X"), (None, None), (9, "A")], "id int, s string")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert quality.not_null_failures(child, "id").count() == 1
    assert {(r.id, r.n_records) for r in quality.unique_failures(child, "id").collect()} == {(2, 2)}
    assert {(r.s, r.n_records) for r in quality.accepted_values_failures(child, "s", ["A", "B"]).collect()} == {("X", 1)}
    assert [r.id for r in quality.relationships_failures(child, "id", parent, "id").collect()] == [9]
    rules = [
        quality.Rule("c", "id", "not_null"),
        quality.Rule("c", "id", "unique"),
        quality.Rule("c", "s", "accepted_values", ("A", "B")),
        quality.Rule("c", "id", "relationships", parent="p", parent_column="id"),
        quality.Rule("p", "id", "unique"),
    ]
    summary = {(r.model, r.test): (r.failures, r.status) for r in quality.run_suite({"c": child, "p": parent}, rules).collect()}
    assert summary == {
        ("c", "not_null"): (1, "fail"),
        ("c", "unique"): (1, "fail"),
        ("c", "accepted_values"): (1, "fail"),
        ("c", "relationships"): (1, "fail"),
        ("p", "unique"): (1, "fail"),
    }


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.sampled_from(["x", "y", "z"])),
    min_size=1,
    max_size=25,
)


@settings(max_examples=25, deadline=None)
@given(rows_strategy)
def test_flags_and_latest_match_brute_force(spark, rows):
    # (key, load, content) rows; the hash is the content incl. key; row id = position
    data = [(k, t, v, f"{k}|{v}", i) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t int, v string, _row_hash string, _row_id int")
    flagged = {r["_row_id"]: r["_is_duplicate"] for r in flag_duplicates(df, ["t", "_row_id"]).collect()}
    first_of = {}
    for k, t, v, h, i in sorted(data, key=lambda r: (r[1], r[4])):
        first_of.setdefault(h, i)
    assert flagged == {i: first_of[h] != i for _, _, _, h, i in data}

    live = [r for r in data if not flagged[r[4]]]
    expected = {}
    for k, t, v, h, i in live:
        best = expected.get(k)
        if best is None or (t, h) > (best[1], best[3]):
            expected[k] = (k, t, v, h, i)
    got = latest_by_key(
        df.where(~F.col("_row_id").isin([i for i, d in flagged.items() if d] or [-1])), "k", [F.desc("t"), F.desc("_row_hash")]
    )
    assert {(r.k, r.t, r.v) for r in got.collect()} == {(k, t, v) for k, t, v, _, _ in expected.values()}


def test_suite_on_empty_model_passes(spark):
    empty = spark.createDataFrame([], "id int, s string")
    rules = [
        quality.Rule("e", "id", "not_null"),
        quality.Rule("e", "id", "unique"),
        quality.Rule("e", "s", "not_null"),
        quality.Rule("e", "s", "accepted_values", ("A",)),
    ]
    got = {(r.column_name, r.test): (r.failures, r.status) for r in quality.run_suite({"e": empty}, rules).collect()}
    assert got == {
        ("id", "not_null"): (0, "pass"),
        ("id", "unique"): (0, "pass"),
        ("s", "not_null"): (0, "pass"),
        ("s", "accepted_values"): (0, "pass"),
    }


def test_materialize_is_released(spark):
    import os

    from curdle.operators.materialize import _STAGED, materialize, release_staged

    df = materialize(spark.range(10), "probe")
    assert df.count() == 10
    path = _STAGED[-1][1]
    local = path[len("file:"):] if path.startswith("file:") else path
    assert os.path.isdir(local)
    assert release_staged() >= 1
    assert not os.path.exists(local)


def test_flag_join_has_no_hot_key(spark):
    """A third of the rows share a hash; the flag join spreads them over all tasks."""
    hot = [("h0", 1, i) for i in range(3000)]
    cold = [(f"h{i}", 1, i) for i in range(1, 6001)]
    df = spark.createDataFrame(hot + cold, "_row_hash string, _batch int, _row_id int")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (flag_duplicates(df, ["_batch", "_row_id"]), flag_against_existing(df, df.select("_row_hash").limit(0), ["_batch", "_row_id"])):
            sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert len(sizes) > 1 and max(sizes) < 1.5 * 9000 / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_warnings_do_not_fail_the_suite(spark):
    df = spark.createDataFrame([(1, None)], "id int, s string")
    rules = [quality.Rule("m", "s", "not_null", severity="warn"), quality.Rule("m", "id", "not_null", severity="warn")]
    got = {r.column_name: (r.failures, r.severity, r.status) for r in quality.run_suite({"m": df}, rules).collect()}
    assert got == {"s": (1, "warn", "warn"), "id": (0, "warn", "pass")}
