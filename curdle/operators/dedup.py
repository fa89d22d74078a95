"""Deduplication operators.

``latest_by_key``  — keep the newest row per key (ROW_NUMBER() … = 1).
``latest_values``  — the same, column by column: columns that nobody reads cost nothing.
``flag_duplicates`` — mark every repeat of a content hash after its first occurrence.
``flag_copies`` — the same for rows that hash and load make up whole: copies move as a count.
``flag_against_existing`` — the incremental form: repeats inside a new batch plus
hashes already stored in the table.

All are skew-tolerant: a single key or hash holding a third of the rows
never has to be sorted or buffered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH = "_row_hash"
DUP = "_is_duplicate"


def latest_by_key(df: DataFrame, key: Column | str, order: Sequence[Column]) -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` (newest first).

    Planned as a top-1 window; Spark inserts a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most one row per key and a hot
    key (or the null key) reaches the reducer as a handful of rows.
    ``order`` must be a total order inside a key for the pick to be stable.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    w = Window.partitionBy(key_col).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_values(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """``latest_by_key`` (of the greatest ``order``, nulls least) as one aggregate, combined before the shuffle.

    The key stands for itself, so in its own right it asks for no order; each other column is an aggregate of its
    own, which Spark leaves out where it is not read. Columns of rows with one key and one order must be alike.
    """
    place = F.struct(*order)
    return df.groupBy(key).agg(*[F.max_by(f"`{c}`", place).alias(c) for c in df.columns if c != key])


def flag_duplicates(df: DataFrame, order: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """``_is_duplicate`` = the row is not the first occurrence of its hash by ``order``.

    ``order`` must identify a row. One partial (map-side combined) aggregation gives
    each hash's first place; a row is first iff hash and whole place equal it. The
    join key is unique to a row, so however many copies a hash has, no task gets more
    than its share.
    """
    return _flag(df, _firsts(df, order, hash_col), order, hash_col)


#: Copies of a hash that ``flag_copies`` writes out from one array, at most.
COPIES = 1 << 16


def flag_copies(df: DataFrame, load: str, loads: int, hash_col: str = HASH) -> DataFrame:
    """(``hash_col``, ``load``, ``_is_duplicate``): ``flag_duplicates`` of rows that have no other columns and so no place of their own.

    ``load`` numbers a row's load (0 … ``loads`` - 1, in order). Copies are counted per hash before they move, and
    only hashes in 16 bytes and counts do; behind the shuffle each count stands for its rows again, of which the
    first of the first load that has any is no duplicate. ``hash_col`` is lower hex.
    """
    per_hash = df.groupBy(F.unhex(hash_col).alias("__hash")).agg(*[F.count_if(F.col(load) == i).alias(f"__n{i}") for i in range(loads)])
    earlier, held = F.lit(False), []
    for i in range(loads):
        held.append(F.struct(F.lit(i).alias(load), F.col(f"__n{i}").alias("__n"), (~earlier).alias("__first")))
        earlier = earlier | (F.col(f"__n{i}") > 0)
    per_load = per_hash.select("__hash", F.inline(F.array(*held))).where("__n > 0")
    blocks = per_load.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES))))
    left = F.col("__n") - F.col("__block") * COPIES
    rows = blocks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(left, F.lit(COPIES).cast("long")))))
    first = F.col("__first") & (F.col("__block") == 0) & (F.col("__copy") == 1)
    return rows.select(F.lower(F.hex("__hash")).alias(hash_col), load, (~first).alias(DUP))


def flag_against_existing(
    batch: DataFrame,
    existing_hashes: DataFrame | None,
    order: Sequence[str],
    hash_col: str = HASH,
) -> DataFrame:
    """Flag a new batch: repeats inside it, or hashes already present in the table.

    ``existing_hashes`` is a one-column DataFrame of stored hashes (any number of
    repeats). The batch's first places whose hash
    is stored are dropped, so every row of such a hash is a duplicate.
    """
    first = _firsts(batch, order, hash_col)
    if existing_hashes is not None:
        stored = existing_hashes.select(F.col(hash_col).alias("__stored"))
        first = first.join(stored, F.col("__hash") == F.col("__stored"), "left_anti")
    return _flag(batch, first, order, hash_col)


def repeats(df: DataFrame, firsts: DataFrame, order: Sequence[str], hash_col: str = HASH) -> DataFrame:
    """The places (``order``) of the rows whose hash and place are not in ``firsts``: narrow, and no hash weighs more than its rows."""
    return df.select(hash_col, *order).join(firsts.select(hash_col, *order), [hash_col, *order], "left_anti").select(*order)


def mark_repeats(df: DataFrame, places: DataFrame, order: Sequence[str]) -> DataFrame:
    """``_is_duplicate`` is true for the rows whose place (``order``, unique to a row) is in ``places``, else false."""
    marked = df.join(places.select(*order, F.lit(True).alias(DUP)), list(order), "left")
    return marked.withColumn(DUP, F.coalesce(DUP, F.lit(False)))


def _firsts(df: DataFrame, order: Sequence[str], hash_col: str) -> DataFrame:
    first = df.groupBy(hash_col).agg(F.min(F.struct(*order)).alias("__first"))
    return first.select(F.col(hash_col).alias("__hash"), *[F.col(f"__first.{c}").alias(f"__{c}") for c in order])


def _flag(df: DataFrame, firsts: DataFrame, order: Sequence[str], hash_col: str) -> DataFrame:
    same = F.col(hash_col) == F.col("__hash")
    for c in order:
        same = same & (F.col(c) == F.col(f"__{c}"))
    marked = df.join(firsts, same, "left")
    return marked.withColumn(DUP, F.col("__hash").isNull()).drop("__hash", *[f"__{c}" for c in order])
