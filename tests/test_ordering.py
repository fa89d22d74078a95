"""Row numbers of a global order against a plain sort."""

import random

from pyspark.sql import functions as F

from curdle.operators.ordering import with_row_number


def test_numbers_follow_the_order_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), i) for i in range(2000)]  # a third of the rows share a key
    df = spark.createDataFrame(rows, "k int, i int").repartition(7)
    got = [(r.row_no, r.k, r.i) for r in with_row_number(df, [F.col("k").asc_nulls_last(), F.col("i").desc()]).orderBy("row_no").collect()]
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert got == [(n, k, i) for n, (k, i) in enumerate(want, 1)]
    assert with_row_number(df.limit(0), [F.col("k")]).collect() == []


def test_no_window_over_all_rows(spark):
    plan = with_row_number(spark.range(100), [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # the sorted rows are read back
    assert plan.count("SinglePartition") <= 1  # over one row a partition
