"""Numeric helpers.

Measures are typed DECIMAL(18,4) so sums are exact and independent of the
summation order (the reference's NUMERIC is exact too). Averages and ratios are
computed in DOUBLE from exact sums, pushed through DECIMAL(38,10) and rounded
half-up, which gives the same digits on any engine that follows the recipe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

NUMERIC = DecimalType(18, 4)
# What text is parsed as before it is known to fit.
_PARSE = DecimalType(38, 18)
_RATIO_DECIMAL = DecimalType(38, 10)


def to_numeric(c: Column, strict: bool = True) -> Column:
    """Text → DECIMAL(18,4), never rounded on the way.

    A number that the type cannot hold exactly is like bad text: strict raises,
    lenient yields null. Only texts that may hold more than four decimals are looked
    at twice.
    """
    narrow = c.cast(NUMERIC) if strict else c.try_cast(NUMERIC)
    full = c.cast(_PARSE) if strict else c.try_cast(_PARSE)
    lost = F.raise_error(F.concat(F.lit("number does not fit DECIMAL(18,4): "), c)) if strict else F.lit(None)
    checked = F.when(full == full.cast(NUMERIC), narrow).when(full.isNotNull(), lost.cast(NUMERIC))
    return F.when(c.rlike(r"[.]\d{5}|[eE]"), checked).otherwise(narrow)


def to_int(c: Column, strict: bool = True) -> Column:
    return c.cast("int") if strict else c.try_cast("int")


def to_bigint(c: Column, strict: bool = True) -> Column:
    return c.cast("bigint") if strict else c.try_cast("bigint")


def as_double(c: Column) -> Column:
    return c.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / NULLIF(denominator, 0)`` in DOUBLE."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def round_ratio(c: Column, digits: int) -> Column:
    """Round a DOUBLE half-up to ``digits`` through DECIMAL(38,10); the result stays DECIMAL."""
    return F.round(c.cast(_RATIO_DECIMAL), digits)


def round_decimal(c: Column, digits: int) -> Column:
    """Round an exact DECIMAL half-up; the result stays DECIMAL."""
    return F.round(c, digits)


def as_doubles(df: DataFrame) -> DataFrame:
    """Every DECIMAL column as DOUBLE, for comparison with other engines."""
    return df.select(*[as_double(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields])
