"""Aggregation building blocks shared by the gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)`` — null conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))


def sum_when(cond: Column, value: Column) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)`` (pivot-like conditional sum)."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def share_of_period(df: DataFrame, value: str, period: str, out: str) -> DataFrame:
    """Adds ``out`` = the period's total of ``value`` (``SUM(SUM(x)) OVER (PARTITION BY period)``).

    Applied after aggregation, so a period partition holds one row per group,
    never the raw facts.
    """
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(period)))


def reaggregate(df: DataFrame, keys: Sequence[str], sums: Sequence[str], maxes: Sequence[str] = ()) -> DataFrame:
    """Combine partial aggregates after a join: sum counts/sums, max maxima.

    This is what makes "aggregate the fact first, join the dimension, finish the
    aggregate" exact for decomposable measures even when a dimension key matches
    several dimension rows.
    """
    aggs = [F.sum(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in maxes]
    return df.groupBy(*keys).agg(*aggs)
