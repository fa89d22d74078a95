"""Text helpers. Every function maps Column → Column and stays inside codegen."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's ``str.strip()`` removes (derived from ``str.isspace``).
PY_WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace the way Python's ``str.strip()`` does (char-set trim, no regex)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def sql_trim(c: Column) -> Column:
    """SQL ``TRIM``: spaces only, not tabs or newlines."""
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(c, F.lit(""))


def numeric_like(c: Column) -> Column:
    """Bronze numeric clean-up: null/blank → null; strip; decimal comma → point (stays text)."""
    stripped = py_strip(c)
    return F.when(stripped == "", F.lit(None).cast("string")).otherwise(F.translate(stripped, ",", "."))


def regexp_replace_first(c: Column, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match of ``pattern`` (SQL REGEXP_REPLACE without the 'g' flag).

    Spark's ``regexp_replace`` replaces every match; anchoring a lazy prefix at
    the start of the string restricts it to the first one.
    """
    safe = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(c, rf"(?s)\A(.*?)(?:{pattern})", "$1" + safe)


def collapse_first_whitespace_run(c: Column) -> Column:
    """``REGEXP_REPLACE(x, '\\s+', ' ')`` with first-match-only semantics."""
    return regexp_replace_first(c, r"\s+", " ")


def yes_no_flag(c: Column) -> Column:
    """Text → boolean: first letter 'n' → false, 's' → true, anything else (or null) → false."""
    first = F.left(F.lower(c), F.lit(1))
    return F.when(first == "n", F.lit(False)).when(first == "s", F.lit(True)).otherwise(F.lit(False))


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))
