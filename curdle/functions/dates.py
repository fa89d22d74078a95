"""Date helpers: bronze normalisation, regex-guarded parses, month buckets, day differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curdle.functions.text import py_strip

# The three textual date layouts the pipeline recognises.
# \A … \z anchor the whole string (Java's $ would also accept a trailing newline).
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
DMY_SLASH = r"\A[0-9]{2}/[0-9]{2}/[0-9]{4}\z"
MDY_DASH = r"\A[0-9]{2}-[0-9]{2}-[0-9]{4}\z"


def _zfill2(part: Column) -> Column:
    """Python ``str.zfill(2)``: pad to two characters, zeros after a leading sign, never truncate."""
    n = F.length(part)
    return (
        F.when(n >= 2, part)
        .when(part.isin("+", "-"), F.concat(part, F.lit("0")))
        .otherwise(F.lpad(part, 2, "0"))
    )


def normalize_date(c: Column) -> Column:
    """Bronze date normalisation.

    null/blank → null; strip; a 10-character value whose 5th character is '-'
    passes unchanged (not validated); otherwise exactly three '/'-separated
    parts p1/p2/p3 become ``p3-zfill(p2)-zfill(p1)`` (no digit or range check);
    anything else → null.
    """
    return normalize_stripped_date(py_strip(c))


def normalize_stripped_date(s: Column) -> Column:
    """``normalize_date`` of a value that is stripped already (``s`` is read several times)."""
    parts = F.split(s, "/", -1)
    rebuilt = F.concat_ws(
        "-",
        F.element_at(parts, 3),
        _zfill2(F.element_at(parts, 2)),
        _zfill2(F.element_at(parts, 1)),
    )
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when((F.length(s) == 10) & (F.substring(s, 5, 1) == "-"), s)
        .when(F.size(parts) == 3, rebuilt)
        .otherwise(F.lit(None).cast("string"))
    )


def _cast_date(c: Column, strict: bool) -> Column:
    return c.cast("date") if strict else F.try_to_date(c)


def iso_date(c: Column, strict: bool = True) -> Column:
    """``CASE WHEN x ~ '^\\d{4}-\\d{2}-\\d{2}$' THEN x::DATE END``.

    The guard is required: Spark's cast alone accepts '2024-1' or trailing text.
    ``strict`` casts raise on impossible dates (2024-13-01) like the reference;
    ``strict=False`` yields null instead.
    """
    return F.when(c.rlike(ISO_DATE), _cast_date(c, strict))


def multi_format_date(c: Column, strict: bool = True) -> Column:
    """ISO, DD/MM/YYYY or MM-DD-YYYY text → DATE; anything else → null."""
    parse = F.to_date if strict else F.try_to_date
    return (
        F.when(c.rlike(ISO_DATE), _cast_date(c, strict))
        .when(c.rlike(DMY_SLASH), parse(c, "dd/MM/yyyy"))
        .when(c.rlike(MDY_DASH), parse(c, "MM-dd-yyyy"))
    )


def month_start(d: Column) -> Column:
    """``DATE_TRUNC('month', d)::DATE``."""
    return F.trunc(d, "MM")


def days_between(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in whole days (integer), null if either side is null."""
    return F.datediff(later, earlier)
