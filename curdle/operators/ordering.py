"""Row numbers of a global order, without a window over one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curdle.operators.materialize import materialize

_PART_BITS = 33  # of monotonically_increasing_id: the partition above, the row below


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """Adds ``name`` = 1, 2, 3 … in the order of ``order``.

    Rows are dealt to range partitions and sorted there; a partition's first number is the
    sum of the sizes of those before it, taken over one row a partition. The sorted rows are
    written once, so sizes and rows agree however often a task is run.
    """
    ids = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    ids = materialize(ids, "ordered")
    part = F.shiftright("__id", _PART_BITS)
    sizes = ids.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = ids.withColumn("__part", part).join(F.broadcast(offsets), "__part")  # one row a range partition
    row = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << _PART_BITS) - 1)) + 1
    return numbered.withColumn(name, row).drop("__id", "__part", "__before")
