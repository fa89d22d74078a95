"""Ranked lexical search with per-term geometric blocking.

Documents are ranked for each item by a BM25-like score in whole numbers: an item's term that
stands in a document adds weight * impact, the weight from the term's document frequency, the
impact from its count there and the document's length.

Documents and items meet in cells of a grid (document strip x item strip). A cell takes its
documents in pieces; for each term of its items a piece has a posting list. Lists are taken from
the heaviest term on. A list is clustered by document similarity into blocks (each document
goes to the nearest of evenly drawn pivots, by projected impact vectors), and each block holds a
summary: the coordinatewise maximum of its documents' impacts. Weights times summary bound the
score of every document of a block, so a block is skipped for an item exactly when that bound is
below the item's k-th score so far; bounds and scores are exact whole numbers. A document counts
at the first of the item's terms that it has. Cells return k documents an item, a window by
item merges them.

Statistics cover all documents: one pass keeps each document's length and its counts of terms
that items may hold (told by a table of a fixed number of slots, so its size is bounded; terms
that share a slot by chance are dropped by the join with the items' terms). The number of
documents, of terms and the size of the items are all that the driver sees.

Nulls and odd rows: a document without a term takes no part in any count; one without an id
counts and is ranked after all others of equal score; repeated document rows count each. An item
without id or terms has no result; equal item rows count once; rows of one item id with
different texts are ranked apart. Texts of any length are read whole; other columns are ignored,
whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curdle.operators.materialize import materialize

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Slots of the table that tells terms which items may hold.
SLOTS = 1 << 20
#: Documents of a strip, and of a piece inside it; items' terms of a strip; documents of a block, about.
STRIP, PIECE, TERMS, BLOCK = 1 << 15, 2048, 1 << 14, 16
#: Cells of a piece's impact matrix, at most.
AREA = 1 << 25
_LAST = 2**63 - 1


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.encode().lower().decode()) if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(qkey, item_id, term): the distinct terms of each distinct item row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t.as_py()))) for t in batch.column(2)]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([t for f in found for t in f], pa.string())], names=["qkey", "item_id", "term"])

    own = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("item_id IS NOT NULL").distinct()
    return own.select(F.xxhash64("item_id", "text").alias("qkey"), "item_id", "text").mapInArrow(run, "qkey long, item_id long, term string")


def postings(docs: DataFrame, slots: bytes, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, n, terms, counts) of every document with a term; ``terms`` are those whose slot is set."""
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column(1):
                found = terms_of(text.as_py())
                own = [(t, f) for t, f in Counter(found).items() if known[zlib.crc32(t.encode()) % SLOTS]]
                n.append(len(found)), terms.append([t for t, _ in own]), counts.append([f for _, f in own])
            rows = pa.array(np.arange(row, row + len(n)))
            row += len(n)
            yield pa.RecordBatch.from_arrays(
                [rows, batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))], names=["row", "doc_id", "n", "terms", "counts"]
            )

    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, "row long, doc_id long, n long, terms array<string>, counts array<long>").where("n > 0")


class _Cell:
    """The items of one cell, their weights by term, and their best documents so far."""

    def __init__(self, k: int) -> None:
        self.k, self.parts = k, []

    def add_items(self, key, item, terms, weights, ends) -> None:
        self.parts.append((key, item, terms, weights, ends))

    def seal(self) -> None:
        self.key, self.item = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        terms = pa.concat_arrays([p[2] for p in self.parts])
        weight = np.concatenate([p[3] for p in self.parts])
        query = np.repeat(np.arange(len(self.key)), np.concatenate([p[4] for p in self.parts]))
        self.parts = []
        self.vocabulary = pc.unique(terms)
        term = pc.index_in(terms, value_set=self.vocabulary).to_numpy(zero_copy_only=False)
        order = np.lexsort((query, term))
        self.queries_of, self.first = query[order], np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.weight = np.zeros(len(self.vocabulary), dtype=np.int64)
        self.weight[term] = weight
        order = np.lexsort((term, query))
        self.terms_of, self.begin = term[order], np.searchsorted(query[order], np.arange(len(self.key) + 1))
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(self.key)
        self.bar = np.ones(len(self.key), dtype=np.int64)
        self.project = np.random.Generator(np.random.PCG64(7)).choice(np.float32([-1, 1]), (len(self.vocabulary), 32))

    def piece(self, ids, null, doc, term, impact) -> None:
        """Rank the documents ``ids``, given their postings (place in ``ids``, term, impact)."""
        used, column = np.unique(term, return_inverse=True)
        if len(ids) * len(used) > AREA and len(ids) > 1:
            half = len(ids) // 2
            low = doc < half
            self.piece(ids[:half], null[:half], doc[low], term[low], impact[low])
            self.piece(ids[half:], null[half:], doc[~low] - half, term[~low], impact[~low])
            return
        matrix = np.zeros((len(ids), len(used)), dtype=np.float32)  # impacts are at most 10^6: exact
        matrix[doc, column] = impact
        sketch = matrix @ self.project[used]
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        where = np.full(len(self.vocabulary), -1)
        where[used] = np.arange(len(used))
        by_term = np.argsort(column, kind="stable")
        start = np.searchsorted(column[by_term], np.arange(len(used) + 1))
        fresh = np.ones((len(ids), len(self.key)), dtype=bool)
        for c in np.argsort(-self.weight[used], kind="stable"):
            queries = self.queries_of[self.first[used[c]] : self.first[used[c] + 1]]
            members = doc[by_term[start[c] : start[c + 1]]]
            new = fresh[np.ix_(members, queries)]
            fresh[np.ix_(members, queries)] = False
            members, new = members[some := new.any(axis=1)], new[some]
            if len(members):
                self._list(queries, members, new, matrix, sketch, where, ids, null)

    def _list(self, queries, members, new, matrix, sketch, where, ids, null) -> None:
        """One posting list: blocks of similar documents, and the scores of those that a bound does not rule out."""
        begin = np.zeros(1, dtype=np.int64)
        if len(members) > 2 * BLOCK:
            pivots = members[:: BLOCK]
            label = np.argmax(sketch[members] @ sketch[pivots].T, axis=1)
            order = np.argsort(label, kind="stable")
            members, new, label = members[order], new[order], label[order]
            begin = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
        block = np.repeat(np.arange(len(begin)), np.diff(np.concatenate([begin, [len(members)]])))
        own = [where[self.terms_of[self.begin[q] : self.begin[q + 1]]] for q in queries]
        own = [(self.terms_of[self.begin[q] : self.begin[q + 1]][at >= 0], at[at >= 0]) for q, at in zip(queries, own)]
        columns = np.unique(np.concatenate([at for _, at in own]))
        held = matrix[np.ix_(members, columns)]
        summary = np.maximum.reduceat(held, begin, axis=0).astype(np.int64)
        for j, (q, (terms, at)) in enumerate(zip(queries, own)):
            at, weight = np.searchsorted(columns, at), self.weight[terms]
            passes = summary[:, at] @ weight >= self.bar[q]
            rows = np.flatnonzero(passes[block] & new[:, j])
            if not len(rows):
                continue
            score = held[np.ix_(rows, at)].astype(np.int64) @ weight
            high = score >= self.bar[q]
            if high.any():
                self._merge(q, score[high], ids[members[rows[high]]], null[members[rows[high]]])

    def _merge(self, q, score, ids, null) -> None:
        score, ids, null = (np.concatenate(x) for x in zip(self.best[q], (score, ids, null)))
        order = np.lexsort((ids, null, -score))[: self.k]
        self.best[q] = (score[order], ids[order], null[order])
        if len(order) == self.k:
            self.bar[q] = max(1, score[order[-1]])

    def rows_out(self) -> pa.RecordBatch:
        n = [len(b[0]) for b in self.best]
        score, ids, null = (np.concatenate([b[i] for b in self.best]) for i in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.key, n)), pa.array(np.repeat(self.item, n)), pa.array(ids, mask=null), pa.array(score)], names=["qkey", "item_id", "doc_id", "score"]
        )


def _rank(k: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell, ready = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            where, side, key, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 4))
            null = batch.column(3).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(3).fill_null(_LAST).to_numpy(zero_copy_only=False)
            size = batch.column(5).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            terms, values = batch.column(5).flatten(), batch.column(6).flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(size)])
            cut = np.flatnonzero((np.diff(where) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, len(ids)]):
                if where[a] != now:
                    if ready:
                        yield cell.rows_out()
                    now, cell, ready = where[a], _Cell(k), False
                if side[a] == 0:
                    cell.add_items(key[a:b], ids[a:b], terms[ends[a] : ends[b]], values[ends[a] : ends[b]], size[a:b])
                    continue
                if not ready and not cell.parts:
                    continue  # no item has a term that counts
                if not ready:
                    cell.seal()
                    ready = True
                for x in range(a, b, piece):
                    y = min(x + piece, b)
                    part = slice(ends[x], ends[y])
                    term = pc.index_in(terms[part], value_set=cell.vocabulary)
                    known = term.is_valid().to_numpy(zero_copy_only=False)
                    term = term.fill_null(0).to_numpy(zero_copy_only=False)[known]
                    doc = np.repeat(np.arange(y - x), size[x:y])[known]
                    count = values[part][known]
                    impact = (1_000_000_000 * count) // (1000 * count + 20 * n[x:y][doc])
                    if len(term):
                        cell.piece(ids[x:y], null[x:y], doc, term, impact)
        if ready:
            yield cell.rows_out()

    return run


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    strip: int = STRIP, piece: int = PIECE, item_strip: int = TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0, ties to the smaller id."""
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_id_col, item_text_col), "lexical-items")
    slot = (F.crc32(F.col("term").cast("binary")) % SLOTS).cast("int").alias("slot")
    table = bytearray(SLOTS)
    for r in asked.select(slot).distinct().toLocalIterator():  # SLOTS rows at most
        table[r["slot"]] = 1
    held = materialize(postings(docs, bytes(table), id_col, text_col), "lexical-postings")
    total = held.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["n"], total["terms"] or 1
    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = materialize(asked.join(frequency, "term").select("qkey", "item_id", "term", weight.alias("w")).where("w > 0"), "lexical-weights")
    sizes = weighted.count()
    g_q = max(1, -(-sizes // item_strip))
    g_c = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_docs // strip))
    pairs = F.collect_list(F.struct("term", "w"))
    by_item = weighted.groupBy("qkey", "item_id").agg(pairs.alias("p"))
    c = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g_c - 1).cast("long")))
    queries = by_item.select(c.alias("c"), F.pmod("qkey", F.lit(g_q)).alias("q"), F.lit(0).alias("side"), "qkey", F.col("item_id").alias("id"), F.lit(0).cast("long").alias("n"), F.col("p.term").alias("terms"), F.col("p.w").alias("vals"))
    # The document's length against the mean, in per cent, half of it: 100 - 50 + (50 * n * N) div L.
    m = 50 + F.expr(f"CAST((CAST(50 * n AS DECIMAL(38, 0)) * {n_docs}) DIV {n_terms} AS LONG)")
    q = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(g_q - 1).cast("long")))
    candidates = held.where(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("row"), F.lit(g_c)).alias("c"), q.alias("q"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("qkey"), F.col("doc_id").alias("id"), m.alias("n"), "terms", F.col("counts").alias("vals")
    )
    both = queries.unionByName(candidates).select((F.col("c") * g_q + F.col("q")).alias("cell"), "side", "qkey", "id", "n", "terms", "vals")
    dealt = both.repartition(min(g_c * g_q, 100_000), "cell").sortWithinPartitions("cell", "side")
    found = dealt.mapInArrow(_rank(k, piece), "qkey long, item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id", "qkey").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


ORACLE_SQL = """
WITH toks AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents),
lens AS (SELECT doc_id, r, CAST(len(t) AS BIGINT) AS n FROM toks WHERE len(t) > 0),
tot AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lens),
tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM toks) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM df, tot),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT i.item_id, d.r, d.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * d.n * tot.nd) // tot.l)))) AS BIGINT) AS score
  FROM items i JOIN tf ON i.term = tf.term JOIN w ON w.term = tf.term JOIN lens d ON d.r = tf.r, tot
  GROUP BY i.item_id, d.r, d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
