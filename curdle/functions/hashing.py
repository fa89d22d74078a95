"""Row content hash used for duplicate detection in bronze."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEP = "\u001f"  # unit separator between fields
NULL_MARK = "␀"  # stands for a null value: ``name␀`` (``name=`` is the empty string)


def row_hash(columns: Iterable[str]) -> Column:
    """MD5 (lower hex) over the business columns, sorted by name.

    Each field is ``name=length:value`` or ``name␀`` for null, joined by U+001F.
    The length (in characters) makes the text unambiguous whatever bytes a value
    holds; null, '' and a missing column are all distinct. Metadata columns must
    not be passed in.
    """
    # Built as one SQL expression: a single plan-building call however wide the row is.
    fields = ", ".join(
        f"coalesce(concat('{_sql_str(name)}=', length(`{name}`), ':', `{name}`), '{_sql_str(name)}{NULL_MARK}')" for name in sorted(columns)
    )
    return F.expr(f"md5(cast(concat_ws('{FIELD_SEP}', {fields}) as binary))")


def _sql_str(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
