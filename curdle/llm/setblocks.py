"""Brute force over groups of sets, a pair of blocks at a time, for the similarity joins.

A group of any size is cut into blocks by hash; each task holds two blocks at most,
and gives results per set (counts, flags, forests), never pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_block_pairs(members: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """A row for each pair of blocks of its group that a member (``sid``) takes part in: ``pair`` names it, ``side`` is 0 or 1."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    mine = F.pmod(F.xxhash64("sid", F.lit(11)), F.col("_blocks")).cast("int")
    wide = members.withColumn("_blocks", blocks).withColumn("_own", mine)
    wide = wide.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pair = F.xxhash64(key, F.least("_own", "_other"), F.greatest("_own", "_other"))
    return wide.withColumn("pair", pair).withColumn("side", (F.col("_own") > F.col("_other")).cast("int")).drop("_blocks", "_own", "_other")


Group = dict[str, np.ndarray]


def _column(column: pa.Array, width: int) -> np.ndarray:
    """Numbers as they are; binary as 16-bit rows where its width is fixed, else as bytes objects."""
    if not pa.types.is_binary(column.type):
        return (column.fill_null(0) if column.null_count else column).to_numpy(zero_copy_only=False)
    if width:
        at = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset]
        return np.frombuffer(column.buffers()[2], dtype=np.uint8)[at : at + width * len(column)].view(np.uint16).reshape(len(column), -1)
    out = np.empty(len(column), dtype=object)
    out[:] = column.to_pylist()
    return out


def run_pairs(
    members: DataFrame, work: Callable[[Group], tuple | None], schema: str, twos: Callable[[Group, np.ndarray, np.ndarray], tuple] | None = None, **widths: int
) -> DataFrame:
    """Bring the rows of each ``pair`` (a column) together and apply ``work`` to their columns; it gives the output's columns.

    ``twos``, if given, does all groups of two rows of a batch at once (their first and second row numbers).
    ``widths`` names binary columns of a fixed width, which become matrices.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns, names = members.columns, [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Group | None = None

        def apply(rows: Group, last: bool):
            cut = [0, *(np.flatnonzero(rows["pair"][1:] != rows["pair"][:-1]) + 1), len(rows["pair"])]
            done = len(cut) - 1 if last else len(cut) - 2
            groups, found = zip(cut[:done], cut[1:]), []
            if twos is not None:
                start, size = np.array(cut[:done], dtype=np.int64), np.diff(cut[: done + 1])
                first = start[size == 2]
                if len(first):
                    found.append(twos(rows, first, first + 1))
                groups = zip(start[size > 2], (start + size)[size > 2])
            found += [x for a, b in groups if (x := work({k: v[a:b] for k, v in rows.items()})) is not None]
            out = [pa.array(np.concatenate(c)) for c in zip(*found)]
            # The last group of a batch may go on; it is at most two blocks.
            return pa.RecordBatch.from_arrays(out, names=names) if out else None, {k: v[cut[done] :] for k, v in rows.items()}

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: _column(batch.column(i), widths.get(c, 0)) for i, c in enumerate(columns)}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in columns}
            out, held = apply(rows, False)
            if out is not None:
                yield out
        if held is not None:
            out, _ = apply(held, True)
            if out is not None:
                yield out

    return members.repartition(parts, "pair").sortWithinPartitions("pair").mapInArrow(run, schema)


def labels(links: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component in a symmetric boolean matrix."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def overlaps(first: np.ndarray, tokens: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of every row set with every column set."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(tokens, kind="stable")
    t, owner = tokens[order], owner[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = t[1:] != t[:-1]
    rank = np.cumsum(new) - 1
    shared = np.bincount(rank)[rank] > 1  # a token of one set alone adds nothing
    rank, owner = rank[shared], owner[shared]
    total = np.zeros((len(rows), len(cols)), dtype=np.float32)
    if not len(rank):
        return total
    _, rank = np.unique(rank, return_inverse=True)
    width, last = 2048, int(rank[-1]) + 1
    for lo in range(0, last, width):
        a, b = np.searchsorted(rank, [lo, lo + width])
        has = np.zeros((len(first) - 1, min(width, last - lo)), dtype=np.float32)
        has[owner[a:b], rank[a:b] - lo] = 1
        total += has[rows] @ has[cols].T
    return total


def similar(group: Group, at: np.ndarray, tokens: str, threshold: float) -> np.ndarray:
    """Symmetric matrix of the pairs whose Jaccard similarity is at least ``threshold``; of two blocks, only pairs across."""
    side = group["side"][at]
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group[tokens][at]]
    n = np.array([len(x) for x in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[False, True], [True, False]]) & (both >= threshold * (n.sum() - both) - 1e-6)
    cross = side.any() and not side.all()
    rows = np.flatnonzero(side == 0) if cross else np.arange(len(at))
    cols = np.flatnonzero(side == 1) if cross else rows
    both = overlaps(np.concatenate([[0], np.cumsum(n)]), np.concatenate(sets), rows, cols)
    whole = np.zeros((len(at), len(at)), dtype=bool)
    whole[np.ix_(rows, cols)] = both >= threshold * (n[rows][:, None] + n[cols][None, :] - both) - 1e-6
    whole |= whole.T
    np.fill_diagonal(whole, False)
    return whole
