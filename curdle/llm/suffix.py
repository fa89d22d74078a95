"""Suffix-array dedup: passages of at least ``MIN_WORDS`` words that stand in several documents.

The suffix array is sparse: of all suffixes only those that start at minimisers are
kept, the least k-gram hash of each ``WINDOW`` consecutive word positions. Any window
of MIN_WORDS words has its minimiser among its first WINDOW positions, chosen from
the window's own words alone; so if the window stands twice, both places keep a
suffix there, and the two share at least ``PREFIX`` = MIN_WORDS - WINDOW + 1 words.

Suffixes are sorted over the cluster by their first PREFIX words (as a hash: equal
prefixes stand together, which is all that neighbours are compared for), then by
place. Range partitions split a prefix that a third of all rows share; the first and
last prefix of each partition are compared across partitions in a second step.

Matched suffixes are extended to the left and right over the windows that their
minimiser stands for. The last of these windows is compared first. Where it is
repeated, and the one of the suffix before is too, all between are covered. Where
not, the extension ends somewhere between, or passes from one other document to the
next: then every document with that prefix hashes all of its windows there, with 128
bits, and those found in two documents or more make up the spans, with the others.

Rows carry hashes and positions; texts move once, for documents with a match.

Nulls and odd rows: rows without an id take no part; texts below MIN_WORDS words
(null and empty ones included) have no passage; repeated rows with the same id and
text are one document, rows with the same id and different texts are two; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curdle.llm import kernels as K
from curdle.operators.materialize import materialize

MIN_WORDS = 50
WINDOW = 20
PREFIX = MIN_WORDS - WINDOW + 1
GRAM = 8


def minimisers(h: np.ndarray) -> np.ndarray:
    """For each position, that of the least k-gram hash among the WINDOW positions from there on (ties: the first)."""
    value = K.window_hashes(h, GRAM, 3)
    n = len(value) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    place = np.arange(len(value))
    width, done = 1, []
    left = WINDOW
    # Minima over 1, 2, 4, ... positions, put together to WINDOW.
    while left:
        if left & width:
            done.append((width, value, place))
            left -= width
        if left:
            right = value[width:] < value[:-width]
            value, place = np.where(right, value[width:], value[:-width]), np.where(right, place[width:], place[:-width])
            width *= 2
    at, best, where = 0, None, None
    for width, v, p in sorted(done, key=lambda x: -x[0]):
        v, p = v[at : at + n], p[at : at + n]
        if best is None:
            best, where = v.copy(), p.copy()
        else:
            right = v < best
            best[right], where[right] = v[right], p[right]
        at += width
    return where


def slice_suffixes(data: np.ndarray, offsets: np.ndarray):
    """(document, prefix hash, hash of the last window, first and last window start) of each kept suffix of a slice."""
    _, _, h, first = K.words(data, offsets)
    where = minimisers(h)
    good = np.flatnonzero(K.whole(max(0, len(h) - MIN_WORDS + 1), MIN_WORDS, first))
    if not len(good):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[good]
    p = where[good]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (p[1:] != p[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    lo, hi = good[at], good[np.append(at[1:], len(good)) - 1]
    doc, p = doc[at], p[at]
    base = first[doc]
    return doc, K.window_hashes(h, PREFIX)[p], K.window_hashes(h, MIN_WORDS, 1)[hi], lo - base, hi - base


_SHAPE = "prefix long, doc_id long, th long, lo int, more byte, tail long"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in K.text_slices(batch.column(2)):
            doc, prefix, tail, lo, hi = slice_suffixes(data, offsets)
            if len(doc):
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        K.as_long(prefix), batch.column(0).slice(a, b - a).take(rows), batch.column(1).slice(a, b - a).take(rows),
                        pa.array(lo, pa.int32()), pa.array(hi - lo, pa.int8()), K.as_long(tail),
                    ],
                    names=["prefix", "doc_id", "th", "lo", "more", "tail"],
                )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each suffix of a sorted partition with those beside it.

    Gives matched suffixes, and as ``edge`` rows one suffix each of the partition's
    first and last prefix, which may go on in the partitions beside it. Only the
    one row before the current batch is held.
    """
    held, held_twin, opening = None, False, None

    def out(batch: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([edge] * batch.num_rows)], names=[*batch.schema.names, "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        else:
            yield out(batch.slice(0, 1), True)
        prefix = batch.column(0).to_numpy()
        same = prefix[1:] == prefix[:-1]
        twin = np.zeros(len(prefix), dtype=bool)
        twin[1:] |= same
        twin[:-1] |= same
        twin[0] |= held_twin
        body = twin[:-1]
        if body.any():
            yield out(batch.take(pa.array(np.flatnonzero(body))), False)
        held, held_twin = batch.slice(len(prefix) - 1, 1), bool(twin[-1])
    if held is not None:
        if held_twin:
            yield out(held, False)
        yield out(held, True)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 128-bit hashes of all windows that a document's marked suffixes stand for."""
    for batch in batches:
        marks = batch.column(3)
        for a, b, data, offsets in K.text_slices(batch.column(2)):
            _, _, h, first = K.words(data, offsets)
            x, y = K.window_hashes(h, MIN_WORDS, 1), K.window_hashes(h, MIN_WORDS, 2)
            for i in range(a, b):
                m = marks[i].values
                lo, n = m.field("lo").to_numpy(), m.field("more").to_numpy().astype(np.int64) + 1
                s = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                g, row = s + first[i - a], pa.array(np.zeros(len(s), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1).take(row), batch.column(1).slice(i, 1).take(row), pa.array(s, pa.int32()), K.as_long(x[g]), K.as_long(y[g])],
                    names=["doc_id", "th", "s", "x", "y"],
                )


def _in_two_documents(rows: DataFrame, *key: str) -> DataFrame:
    """The keys that two documents have, and the smaller id; partial minima travel, so a frequent key weighs no more."""
    ends = rows.groupBy(*key).agg(*[f(c).alias(f"{n}_{c}") for c in ("doc_id", "th") for n, f in (("min", F.min), ("max", F.max))])
    return ends.where("min_doc_id <> max_doc_id OR min_th <> max_th").select(*key, F.col("min_doc_id").alias("first"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, n_words, first_doc_id) of every span made of repeated windows.

    ``first_doc_id`` is the smallest id of a document with one of the span's windows
    (the document's own, where it is the first).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    own = own.select("doc_id", F.xxhash64("text").alias("th"), "text")
    suffixes = materialize(own.mapInArrow(_suffixes, _SHAPE), "suffixes")
    order = ["prefix", "doc_id", "th", "lo"]
    array = suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    compared = materialize(array.mapInArrow(_neighbours, _SHAPE + ", edge boolean"), "neighbours")
    edges = compared.where("edge").drop("edge").distinct()
    going_on = edges.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1")
    matched = compared.where("NOT edge").drop("edge").unionByName(edges.join(going_on, "prefix", "left_semi")).distinct()
    in_doc = Window.partitionBy("doc_id", "th").orderBy("lo")
    known = matched.join(_in_two_documents(matched, "prefix", "tail"), ["prefix", "tail"], "left")
    known = known.withColumn("hi", F.col("lo") + F.col("more"))
    covered = F.col("first").isNotNull() & F.lag("first").over(in_doc).isNotNull() & (F.lag("hi").over(in_doc) + 1 == F.col("lo"))
    known = materialize(known.withColumn("covered", F.coalesce(covered, F.lit(False))), "matched")
    # Where documents of one prefix go on differently, a window may be in more documents than a tail tells of.
    ends = known.groupBy("prefix").agg(F.min("tail").alias("least"), F.max("tail").alias("most"))
    parted = ends.where("least <> most").select("prefix")
    open_prefixes = known.where("NOT covered").select("prefix").unionByName(parted).distinct()
    # The positions of one document, bounded by its length.
    mark = F.struct("lo", F.col("more").cast("int").alias("more"))
    marks = known.join(open_prefixes, "prefix", "left_semi").groupBy("doc_id", "th").agg(F.collect_set(mark).alias("marks"))
    texts = own.join(marks, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).select("doc_id", "th", "text", "marks")
    windows = materialize(texts.mapInArrow(_windows, "doc_id long, th long, s int, x long, y long"), "windows")
    found = windows.join(_in_two_documents(windows, "x", "y"), ["x", "y"]).select("doc_id", "th", "s", "first")
    found = found.unionByName(known.where("first IS NOT NULL").select("doc_id", "th", F.col("hi").alias("s"), "first"))
    in_doc = Window.partitionBy("doc_id", "th").orderBy("s")
    new = F.coalesce(F.col("s") > F.lag("s").over(in_doc) + MIN_WORDS, F.lit(True)).cast("int")
    islands = found.withColumn("_new", new).withColumn("_span", F.sum("_new").over(in_doc))
    return islands.groupBy("doc_id", "th", "_span").agg(F.min("s").alias("start_word"), (F.max("s") + MIN_WORDS).alias("end_word"), F.min("first").alias("first_doc_id")).select(
        "doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "first_doc_id"
    )
