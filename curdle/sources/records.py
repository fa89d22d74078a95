"""Records of delimited files whose quoted fields hold line breaks, without giving up split files.

Spark splits a text file anywhere and reads physical lines; whether a line begins a record
depends on every quote before it. A line acts on one bit, "inside a quoted field", as a
function: it keeps the bit, flips it, or sets it. Lines of a split are composed in order, the
splits of a file by a prefix over one row a split, and from a split's first bit each of its
lines gets its own. So no task sees more of a file than one split, however large the file.

Quotes count as the usual reader of delimited text takes them: one opens a field only at its
start, two inside a quoted field stand for one, and what follows a closing quote up to the
delimiter belongs to the field as it is.

A record that is longer than ``longest`` characters, or is still open when its file ends, is
not joined: each of its lines becomes a row that cannot load, so a stray quote that swallows
the rest of a file never has to fit into one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curdle.operators.materialize import materialize

#: Characters of a record that is joined, at most.
LONGEST = 16 << 20
_AT = ["file", "block", "line"]


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): the lines of all files under ``path`` and their places.

    ``line`` grows inside a split; it numbers lines apart, not from one."""
    return with_places(spark.read.option("lineSep", "\n").text(path))


def with_places(text: DataFrame) -> DataFrame:
    """``physical_lines`` of a text scan that has not been read yet (batch or stream)."""
    at = F.col("_metadata")
    return text.select(
        at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )


def _patterns(delimiter: str) -> tuple[str, str]:
    """Regular expressions for a line that ends inside a quoted field, begun outside and inside of one.

    All loops are possessive: no backtracking, and no recursion on long lines.
    """
    d = re.escape(delimiter)
    inside = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{inside}"(?:[^"{d}][^{d}]*+)?+|[^"{d}][^{d}]*+)?+'
    opened = f'(?:{field}{d})*+"{inside}\\z'
    return f"\\A{opened}", f'\\A{inside}(?:\\z|"(?:[^"{d}][^{d}]*+)?+{d}{opened})'


def line_effects(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """Adds ``from_out`` and ``from_in``: whether the line ends inside a quoted field, by where it begins."""
    out, inside = _patterns(delimiter)
    quoted = F.col("value").contains('"')
    return lines.withColumns({"from_out": quoted & F.col("value").rlike(out), "from_in": ~quoted | F.col("value").rlike(inside)})


def has_quoted_breaks(lines: DataFrame, delimiter: str = ",") -> bool:
    """Whether any line ends inside a quoted field that it opens (the scan stops at the first)."""
    return not line_effects(lines, delimiter).where("from_out").isEmpty()


def _composed(order) -> tuple[Column, Column, Column]:
    """The effect of all rows of a window so far: (whether it sets the bit, to what, whether it flips it else)."""
    flips = F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(order)
    sets = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("to"), flips.alias("flips")))
    last = F.last(sets, ignorenulls=True).over(order)
    return last.isNotNull(), last["to"], (flips - F.coalesce(last["flips"], F.lit(0))) % 2 == 1


def _bit(begin: Column, sets: Column, to: Column, flips: Column) -> Column:
    return F.when(sets, to).otherwise(begin) != flips


def logical_records(lines: DataFrame, delimiter: str = ",", longest: int = LONGEST) -> DataFrame:
    """(split, line, first, record, lost): each record once, at the place of its first line.

    ``split`` numbers the splits of all files in order. ``first`` marks the first record of a
    file (its header). A record has its text in ``record`` with line feeds where it was broken;
    a line of a record that cannot be joined has its text in ``lost`` instead. Carriage returns
    that end a record are cut.
    """
    split = Window.partitionBy("file", "block").orderBy("line")
    effect = _composed(split)
    within = line_effects(lines, delimiter).withColumns({"out": _bit(F.lit(False), *effect), "in": _bit(F.lit(True), *effect), "nth": F.row_number().over(split)})
    # For both bits that the split may begin with: how far back the line's record begins (null: before the split).
    back = {
        f"back_{c}": F.col("line") - F.last(F.when(~F.lag(c, 1, c == "in").over(split), F.col("line")), ignorenulls=True).over(split) for c in ("out", "in")
    }
    within = within.withColumns(back).withColumn("first", (F.col("block") == 0) & (F.col("nth") == 1))
    # Written once: places are given by the scan, and several passes have to agree on them.
    within = materialize(within.select(*_AT, "value", "first", "out", "in", *back), "physical-lines")
    # One row a split, small enough for every task; the lines do not move to meet it.
    splits = F.broadcast(materialize(_splits(within), "splits"))
    own = F.when(F.col("begin"), F.col("back_in")).otherwise(F.col("back_out"))
    placed = within.join(splits, ["file", "block"]).withColumn("back", own)
    start = F.when(F.col("back").isNotNull(), F.struct("split", (F.col("line") - F.col("back")).alias("line")))
    placed = placed.select(
        "split", "line", "value", "first", F.coalesce(F.col("back") > 0, F.lit(True)).alias("begins_in"),
        F.when(F.col("begin"), F.col("in")).otherwise(F.col("out")).alias("ends_in"), F.coalesce(start, "carried").alias("start"),
    )
    whole = placed.where("NOT begins_in AND NOT ends_in").select("split", "line", "first", F.col("value").alias("record"), F.lit(None).cast("string").alias("lost"))
    return whole.unionByName(_joined(placed.where("begins_in OR ends_in"), longest))


def _splits(within: DataFrame) -> DataFrame:
    """(file, block, split, begin, carried): each split's number and first bit, and the start of the record that it begins in."""
    effects = within.groupBy("file", "block").agg(F.max_by(F.struct("out", "in", "back_out", "back_in", "line"), "line").alias("e"))
    per_file = effects.groupBy("file").agg(F.count("*").alias("n"))
    files = per_file.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = effects.join(files, "file").withColumns({"split": F.col("base") + F.row_number().over(order) - 1, "from_out": F.col("e.out"), "from_in": F.col("e.in")})
    splits = splits.withColumn("after", _bit(F.lit(False), *_composed(order)))
    splits = splits.withColumn("begin", F.coalesce(F.last("after").over(before), F.lit(False)))
    # The last start of each split is that of the lines that follow splits begin with.
    back = F.when(F.col("begin"), F.col("e.back_in")).otherwise(F.col("e.back_out"))
    last = F.when(back.isNotNull(), F.struct("split", (F.col("e.line") - back).alias("line")))
    splits = splits.withColumn("last", last).withColumn("carried", F.last("last", ignorenulls=True).over(before))
    return splits.select("file", "block", "split", "begin", "carried")


def _joined(parts: DataFrame, longest: int) -> DataFrame:
    """The records of more than one line, from their lines."""
    sizes = parts.groupBy("start").agg(F.sum(F.length("value") + 1).alias("size"), F.max_by("ends_in", F.struct("split", "line")).alias("open"))
    # Few, or of very many lines each: those are the ones whose lines do not meet.
    apart = sizes.where((F.col("size") > longest) | F.col("open")).select("start", F.lit(True).alias("apart"))
    judged = parts.join(apart, "start", "left")
    own = F.struct("split", "line", "value")
    record = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(own)), lambda x: x["value"]))
    joined = judged.where("apart IS NULL").groupBy("start").agg(record.alias("record"), F.bool_or("first").alias("first"))
    joined = joined.select("start.split", "start.line", "first", "record", F.lit(None).cast("string").alias("lost"))
    return joined.unionByName(judged.where("apart").select("split", "line", "first", F.lit(None).cast("string").alias("record"), F.col("value").alias("lost")))


def parse_records(records: DataFrame, header: list[str], delimiter: str, corrupt: str) -> DataFrame:
    """Header columns as text, ``corrupt`` (the raw text of a malformed record, else null), ``_line`` and ``_lost``.

    ``_line`` orders the records; ``_lost`` is the text of a line whose record cannot be joined.
    Header records and records of white space alone are left out, as the file reader does.
    """
    text = F.coalesce(F.regexp_replace("record", "\r\\z", ""), "lost")
    rows = records.where(~F.col("first")).withColumn("_text", text).where("trim(_text) <> ''")
    rows = rows.withColumn("_line", F.shiftleft("split", 33) + F.col("line").bitwiseAND(F.lit((1 << 33) - 1)))
    names = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*header, corrupt])
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "multiLine": "true"}
    parsed = rows.withColumn("_r", F.when(F.col("lost").isNull(), F.from_csv("_text", names, options)))
    return parsed.select(*[F.col("_r")[c].alias(c) for c in [*header, corrupt]], "_line", F.col("lost").alias("_lost"))
