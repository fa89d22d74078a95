"""Exact top-k inner-product search by columnar branch and bound.

Vectors become integers, floor(scale * x). Queries and candidates meet in cells
of a grid (query strip x candidate strip): each cell's rows arrive sorted, first
its queries (at most about ``query_strip`` of them), then its candidates in
order of id, which stream through in bounded pieces. A piece is held vertically
(a row for each dimension). The product is accumulated dimension block by block;
after each block a candidate stays only if its partial product plus the bound
|rest of query| * |rest of candidate| can still beat the query's k-th score, and
the survivors are compacted. Each cell returns k rows a query; a window by query
merges the cells.

The work is queries x candidates by definition; rows shuffled are candidates x
query strips + queries x candidate strips, and a task holds one query strip and
one piece. Nothing is broadcast or collected but two counts.

Nulls and odd rows: a vector that is null or holds a null or non-finite component
takes no part; vectors of another length than the query's are not comparable and
are no candidates of it. A query's own id is no candidate. Repeated candidate
rows count each; repeated query rows (same id and vector) count once. A row
without an id takes no part. Scores beyond 64 bits saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LONG_MAX, LONG_MIN = 2**63 - 1, -(2**63)
#: Dimensions accumulated between two compactions.
BLOCK = 16
#: Candidates worked on at once; the first pieces are smaller, so that bounds are tight early.
PIECE = 4096
EXACT = 2.0**53


class _Cell:
    """The queries of one cell (of one vector length) and their best candidates so far."""

    def __init__(self, k: int) -> None:
        self.k, self.keys, self.ids, self.rows = k, [], [], []
        self.ready = False

    def add_queries(self, keys, ids, rows) -> None:
        self.keys.append(keys), self.ids.append(ids), self.rows.append(rows)

    def seal(self) -> None:
        self.key = np.concatenate(self.keys)
        self.id = np.concatenate(self.ids)
        self.q = np.concatenate(self.rows)
        self.blocks = [slice(i, i + BLOCK) for i in range(0, max(1, self.q.shape[1]), BLOCK)]
        self.rest_q = self._rest(self.q.T)
        self.best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in self.key]
        self.bar = np.full(len(self.key), -np.inf)
        self.peak = float(np.abs(self.q).max(initial=0.0))
        self.ready = True

    def _rest(self, vertical: np.ndarray) -> np.ndarray:
        """Euclidean mass of the dimensions from each block on (blocks + 1 rows), a little enlarged for rounding."""
        mass = [np.square(vertical[b]).sum(axis=0) for b in self.blocks]
        tail = np.cumsum(mass[::-1], axis=0)[::-1]
        return np.vstack([np.sqrt(tail) * (1 + 1e-9), np.zeros((1, vertical.shape[1]))])

    def scan(self, ids: np.ndarray, rows: np.ndarray) -> None:
        if not self.ready:
            self.seal()
        at, step = 0, 256
        while at < len(ids):
            self._piece(ids[at : at + step], rows[at : at + step])
            at, step = at + step, min(PIECE, step * 4)

    def _piece(self, ids: np.ndarray, rows: np.ndarray) -> None:
        peak = float(np.abs(rows).max(initial=0.0))
        if self.peak * peak * max(1, rows.shape[1]) >= EXACT:
            return self._piece_big(ids, rows)
        vertical = np.ascontiguousarray(rows.T)
        rest_c = self._rest(vertical)
        head = self.blocks[0]
        for t in range(0, len(self.key), 64):
            tile = slice(t, t + 64)
            part = self.q[tile, head] @ vertical[head]
            alive = part + self.rest_q[1][tile, None] * rest_c[1][None, :] + 1e-6 > self.bar[tile, None]
            alive &= ids[None, :] != self.id[tile, None]
            for j in np.flatnonzero(alive.any(axis=1)):
                i, left = t + j, np.flatnonzero(alive[j])
                score = part[j, left]
                for b in range(1, len(self.blocks)):
                    score = score + self.q[i, self.blocks[b]] @ vertical[self.blocks[b]][:, left]
                    stays = score + self.rest_q[b + 1, i] * rest_c[b + 1, left] + 1e-6 > self.bar[i]
                    if not stays.all():
                        left, score = left[stays], score[stays]
                    if not len(left):
                        break
                if len(left):
                    self._merge(i, score, ids[left])

    def _piece_big(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Products too large for exact doubles: Python integers, without pruning."""
        exact = np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape)
        for i in range(len(self.key)):
            q = np.array([int(x) for x in self.q[i]], dtype=object)
            score = [min(LONG_MAX, max(LONG_MIN, int(s))) for s in (exact * q).sum(axis=1)]
            keep = ids != self.id[i]
            self._merge(i, np.array(score, dtype=object)[keep], ids[keep])

    def _merge(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        old_score, old_ids = self.best[i]
        score, ids = np.concatenate([old_score, score]), np.concatenate([old_ids, ids])
        order = sorted(range(len(ids)), key=lambda j: (-score[j], ids[j])) if score.dtype == object else np.lexsort((ids, -score))
        order = order[: self.k]
        self.best[i] = (score[order], ids[order])
        if len(order) == self.k:
            # Candidates come in order of id: one that only equals the k-th score has a larger id and loses the tie.
            self.bar[i] = float(score[order[-1]]) if score.dtype != object else -np.inf

    def rows_out(self) -> pa.RecordBatch | None:
        if not self.ready:
            return None
        n = [len(ids) for _, ids in self.best]
        if not sum(n):
            return None
        score = [int(s) for found, _ in self.best for s in found]
        ids = np.concatenate([ids for _, ids in self.best])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.key, n)), pa.array(np.repeat(self.id, n)), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
            names=["qkey", "query_id", "vec_id", "score"],
        )


def _scan(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])  # cell, dims, side
            qkey = batch.column(3).to_numpy(zero_copy_only=False)
            ids = batch.column(4).to_numpy(zero_copy_only=False)
            values = batch.column(5)
            flat = np.asarray(values.flatten())
            ends = np.concatenate([[0], np.cumsum(key[1])])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cut], [*cut, len(ids)]):
                where = (key[0, a], key[1, a])
                if where != now:
                    if cell is not None and (out := cell.rows_out()) is not None:
                        yield out
                    now, cell = where, _Cell(k)
                rows = flat[ends[a] : ends[b]].reshape(b - a, int(key[1, a])).astype(np.float64)
                if key[2, a] == 0:
                    cell.add_queries(qkey[a:b].astype(np.int64), ids[a:b], rows)
                elif cell.keys:
                    cell.scan(ids[a:b], rows)
        if cell is not None and (out := cell.rows_out()) is not None:
            yield out

    return run


def top_k(
    vectors: DataFrame,
    is_query: str = "vec_id % 100 = 0",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    scale: int = 1024,
    query_strip: int = 4096,
    candidate_strip: int = 1 << 18,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query row, ties to the smaller id."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.expr(is_query).alias("is_query"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < F.lit(float("inf"))))
    own = own.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    own = own.select("vec_id", "is_query", F.transform("v", lambda x: _floor(x, scale)).alias("v"))
    counts = own.select("is_query").agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    g_q = max(1, -(-int(counts["q"] or 0) // query_strip))
    g_c = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts["n"] // candidate_strip))
    dims = F.size("v").alias("dims")
    queries = own.where("is_query").dropDuplicates(["vec_id", "v"]).select("vec_id", "v", F.xxhash64("vec_id", "v").alias("qkey"))
    queries = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(g_c - 1))).alias("c"), F.pmod("qkey", F.lit(g_q)).alias("q"), dims, F.lit(0).alias("side"), "qkey", "vec_id", "v"
    )
    candidates = own.select(
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(g_c)).cast("int").alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g_q - 1).cast("long"))).alias("q"),
        dims, F.lit(1).alias("side"), F.lit(0).cast("long").alias("qkey"), "vec_id", "v",
    )
    both = queries.unionByName(candidates).select((F.col("c") * F.lit(g_q) + F.col("q")).cast("long").alias("cell"), "dims", "side", "qkey", "vec_id", "v")
    dealt = both.repartition(g_c * g_q if g_c * g_q < 100_000 else 100_000, "cell").sortWithinPartitions("cell", "dims", "side", "vec_id")
    found = dealt.mapInArrow(_scan(k), "qkey long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _floor(x, scale):
    """floor(scale * x) as a double, so that no component overflows a long."""
    scaled = x.cast("double") * F.lit(float(scale))
    whole = F.rint(scaled)
    return F.when(whole > scaled, whole - 1).otherwise(whole)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
