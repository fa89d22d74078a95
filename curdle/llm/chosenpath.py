"""N-gram Jaccard join by chosen paths.

A document is its set of word n-grams (``NGRAM`` words; a shorter text is one gram of
all its words). Equal sets are one set with a count of copies. In each run a set walks
all paths of a random tree: at a node it takes the tokens whose hash, seeded by the
path, falls below rate / (threshold * set size), so two sets as similar as the
threshold agree on ``RATE`` children or more on average, and unrelated sets on almost
none. Sets that share a path are a bucket. Buckets of up to ``LIMIT`` sets are brute
forced; larger ones are split by their children, and what is still large at the
last level is brute forced in pairs of blocks, which miss nothing. The number of runs
follows from the target recall and the survival chance of such a path
(``runs_for``); it holds for pairs at the threshold, closer ones do better.

Brute force compares minhash sketches with a margin below the threshold (four
standard deviations), and yields only a spanning forest of what it finds. The
components of that forest hold all pairs found; inside each, every pair of sets is
verified by its exact Jaccard similarity, again in pairs of blocks, each task giving
counts and a forest, never pairs. So links of a group of thousands are counted in
full without being written.

Nulls and odd rows: rows without an id or without a word (null or empty text) have no
links and are their own class; repeated rows are copies of one another; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curdle.llm import kernels as K
from curdle.llm.components import connected_components
from curdle.llm.setblocks import Group, in_block_pairs, labels, run_pairs, similar
from curdle.operators.materialize import materialize

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
RATE = 1.2
DEPTH = 3
LIMIT = 64
SKETCH = 64
#: Sets of a bucket or component that are compared at once; larger ones meet in pairs of blocks of this size.
SKETCH_BLOCK, VERIFY_BLOCK = 2048, 512
#: Token positions expanded at once while paths are walked.
_STEP = 1 << 18

_ODD = K.mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)


def runs_for(recall: float = RECALL, rate: float = RATE, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold shares a path down to the last level with this chance."""
    alive = 1.0
    for _ in range(depth):  # Poisson branching: extinct if no child survives
        alive = 1 - math.exp(-rate * alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def _walk(first: np.ndarray, tokens: np.ndarray, runs: int, threshold: float):
    """The nodes of every set on each level: (set, path, index of the parent among the set's nodes one level up)."""
    size = np.diff(first)

    def bar_at(level: int) -> np.ndarray:
        # Tokens that the path has used, and as many that only one of two sets may hold, are no longer there to agree on.
        limit = np.minimum(RATE / (threshold * np.maximum(size - 2 * level, 1)), 1.0)
        # Two different sets of n tokens or less agree in at most n of n + 1: so short ones match equal sets only, which are one set.
        limit[size + 1e-9 < threshold * (size + 1)] = -1.0
        return np.where(limit < 0, 0.0, np.minimum(limit * 2.0**64, 2.0**64 - 2048)).astype(np.uint64)

    bar_of_token = np.repeat(bar_at(0), size)
    set_of_token = np.repeat(np.arange(len(size)), size)
    owner, path, used = [], [], []
    for r in range(runs):
        salt = K.seed(1000 + r)
        at = np.flatnonzero(K.mix(tokens ^ salt) < bar_of_token)
        owner.append(set_of_token[at]), path.append(K.mix(tokens[at] + salt)), used.append(tokens[at])
    owner, path, used = np.concatenate(owner), np.concatenate(path), np.concatenate(used)[:, None]
    order = np.argsort(owner, kind="stable")
    owner, path, used = owner[order], path[order], used[order]
    levels = [(owner, path, np.zeros(len(owner), np.int64))]
    for level in range(1, DEPTH):
        found, bar = [], bar_at(level)
        cost = np.concatenate([[0], np.cumsum(size[owner])])
        lo = 0
        while lo < len(owner):
            hi = max(lo + 1, int(np.searchsorted(cost, cost[lo] + _STEP, side="right")) - 1)
            n = size[owner[lo:hi]]
            node = np.repeat(np.arange(lo, hi), n)
            token = tokens[np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[owner[lo:hi]], n)]
            hit = K.mix(token ^ path[node]) < bar[owner[node]]
            for c in range(used.shape[1]):  # a token splits a path once
                hit &= token != used[node, c]
            at = np.flatnonzero(hit)
            found.append((node[at], token[at]))
            lo = hi
        if not found:
            levels.append((np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            continue
        node, token = (np.concatenate(x) for x in zip(*found))
        start = np.searchsorted(owner, owner[node])  # nodes are sorted by owner
        parent = node - start
        path, used = K.mix(token + path[node] * np.uint64(3)), np.column_stack([used[node], token])
        owner = owner[node]
        levels.append((owner, path, parent))
    return levels


def _sketches(first: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """16-bit minhashes (sets x SKETCH); every set must have a token."""
    out = np.empty((len(first) - 1, SKETCH), dtype=np.uint16)
    for i in range(SKETCH):
        out[:, i] = (np.minimum.reduceat((tokens * _ODD[i]) >> np.uint64(16), first[:-1]) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


_LEVELS = "".join(f", p{d} array<long>, q{d} array<int>" for d in range(1, DEPTH + 1))
_SETS = "doc_id {id}, th long, sid long, h long, n int, sketch binary" + _LEVELS


def _signatures(docs: DataFrame, ngram: int, threshold: float, runs: int) -> DataFrame:
    names = [c.split()[0] for c in _SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in K.text_slices(batch.column(1)):
                _, _, h, first_word = K.words(data, offsets)
                owner, token = K.distinct(*K.shingles(h, first_word, ngram))
                has, n = np.unique(owner, return_counts=True)
                if not len(has):
                    continue
                first = np.concatenate([[0], np.cumsum(n)])
                sums = [np.add.reduceat(K.mix(token ^ K.seed(i)), first[:-1]) for i in (1, 2)]
                sketch = _sketches(first, token)
                columns = [
                    *(batch.column(i).slice(a, b - a).take(pa.array(has)) for i in (0, 2)), K.as_long(K.mix(sums[0])), K.as_long(K.mix(sums[1])),
                    pa.array(n, pa.int32()), pa.array([s.tobytes() for s in sketch], pa.binary()),
                ]
                for o, path, parent in _walk(first, token, runs, threshold):
                    count = np.bincount(o, minlength=len(has))
                    cut = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                    columns += [pa.ListArray.from_arrays(cut, K.as_long(path)), pa.ListArray.from_arrays(cut, pa.array(parent, pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "th").mapInArrow(run, _SETS.format(id=kind))


def _leaves(sets: DataFrame, limit: int) -> DataFrame:
    """(path, size, sid) of every bucket of two sets or more that is not split further."""
    out, big = None, None
    for d in range(1, DEPTH + 1):
        if d == 1:
            nodes = sets.select("sid", F.explode("p1").alias("path"))
        else:
            up = F.col(f"p{d - 1}")
            node = F.explode(F.zip_with(f"p{d}", f"q{d}", lambda p, q: F.struct(p.alias("path"), F.get(up, q).alias("up"))))
            nodes = sets.select("sid", node.alias("node")).select("sid", "node.path", "node.up")
            nodes = materialize(nodes.join(big, F.col("up") == F.col("big"), "left_semi").select("sid", "path"), f"paths-{d}")
        sizes = materialize(nodes.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), f"buckets-{d}")
        found = nodes.join(sizes if d == DEPTH else sizes.where(F.col("size") <= limit), "path")
        out = found if out is None else out.unionByName(found)
        big = sizes.where(F.col("size") > limit).select(F.col("path").alias("big"))
        if big.isEmpty():
            break
    return out


def _least_equal(threshold: float) -> float:
    return (threshold - 4 * math.sqrt(threshold * (1 - threshold) / SKETCH)) * SKETCH


def _sketch_twos(threshold: float):
    """The buckets of two sets whose sketches and sizes allow the similarity."""
    least = _least_equal(threshold)

    def work(rows: Group, i: np.ndarray, j: np.ndarray) -> tuple:
        n, a, b = rows["n"].astype(np.float64), rows["sid"][i], rows["sid"][j]
        good = (a != b) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]))
        good &= (rows["sketch"][i] == rows["sketch"][j]).sum(axis=1) >= least
        return np.maximum(a, b)[good], np.minimum(a, b)[good]

    return work


def _sketch_forest(threshold: float):
    """A spanning forest of the sets of a bucket whose sketches and sizes allow the similarity."""
    least = _least_equal(threshold)

    def work(group: Group) -> tuple | None:
        sid, at = np.unique(group["sid"], return_index=True)
        if len(sid) < 2:
            return None
        side, sketch, n = group["side"][at], group["sketch"][at], group["n"][at].astype(np.float64)
        cross = side.any() and not side.all()

        def near(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
            small, large = np.minimum(n[rows][:, None], n[cols][None, :]), np.maximum(n[rows][:, None], n[cols][None, :])
            found = small >= threshold * large
            if cross:
                found &= side[rows][:, None] != side[cols][None, :]
            i, j = np.nonzero(found)
            for k in range(0, len(i), 1 << 15):
                part = slice(k, k + (1 << 15))
                found[i[part], j[part]] = (sketch[rows[i[part]]] == sketch[cols[j[part]]]).sum(axis=1) >= least
            return found

        every = np.arange(len(sid))
        if len(sid) <= 64:
            label = labels(near(every, every))
        else:
            label = every.copy()
            for lo in range(0, len(sid), 64):
                rows = every[lo : lo + 64]
                # Only pairs that are not yet connected need comparing.
                one = (label[rows] == label[rows[0]]).all()
                cols = np.flatnonzero(label != label[rows[0]]) if one else every
                if not len(cols):
                    continue
                found = near(rows, cols)
                for r in np.flatnonzero(found.any(axis=1)):
                    met = np.unique(np.append(label[cols[found[r]]], label[rows[r]]))
                    if len(met) > 1:
                        label[np.isin(label, met)] = met[0]
        moved = np.flatnonzero(label != every)
        return (sid[moved], sid[label[moved]]) if len(moved) else None

    return work


def _verify(threshold: float):
    """Links of each set to the others of its two blocks (in documents), and the root of its links' component."""

    def work(group: Group) -> tuple:
        sid, at = np.unique(group["sid"], return_index=True)
        linked = similar(group, at, "grams", threshold)
        return sid, (linked @ group["copies"][at]).astype(np.int64), sid[labels(linked)]

    return work


def _grams(docs: DataFrame, ngram: int) -> DataFrame:
    """(doc_id, sid, grams): the sorted n-gram set of each document with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in K.text_slices(batch.column(1)):
                _, _, h, first_word = K.words(data, offsets)
                owner, token = K.distinct(*K.shingles(h, first_word, ngram))
                has, at = np.unique(owner, return_index=True)
                if len(has):
                    sid = K.mix(np.add.reduceat(K.mix(token ^ K.seed(1)), at))
                    grams = [g.tobytes() for g in np.split(token, at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a).take(pa.array(has)), K.as_long(sid), pa.array(grams, pa.binary())], names=["doc_id", "sid", "grams"]
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, sid long, grams binary")


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", ngram: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT
) -> DataFrame:
    """(doc_id, class_id, n_links, n_grams, th, class_key) of every row.

    ``class_id`` is the smallest id of the documents connected by links (Jaccard
    similarity of ``threshold`` or more); ``n_links`` counts the other documents
    that the row links to directly, its copies included. ``th`` is the text's hash and
    ``class_key`` names the class, which ids cannot where one id has several texts (null: no word).
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    signed = materialize(_signatures(own.where(F.col("doc_id").isNotNull()), ngram, threshold, runs_for(recall)), "signatures")
    levels = [c for d in range(1, DEPTH + 1) for c in (f"p{d}", f"q{d}")]
    sets = signed.groupBy("sid", "h").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "sketch", *levels)]
    )
    sets = materialize(sets, "sets")
    leaves = _leaves(sets, limit)
    members = in_block_pairs(leaves, "path", "size", SKETCH_BLOCK).select("pair", "side", "sid")
    members = members.join(sets.select("sid", "n", "sketch"), "sid").select("pair", "side", "sid", "n", "sketch")
    forest = run_pairs(members, _sketch_forest(threshold), "a long, b long", _sketch_twos(threshold), sketch=2 * SKETCH)
    found = materialize(connected_components(forest, "candidates"), "candidates")
    sizes = found.groupBy("root").agg(F.count("*").alias("size"))
    candidates = found.join(sizes, "root").join(sets.select(F.col("sid").alias("node"), "rep", "copies"), "node")
    candidates = candidates.select(F.col("node").alias("sid"), F.col("root").alias("comp"), "size", F.col("rep").alias("doc_id"), "copies")
    texts = own.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    grams = _grams(texts, ngram).join(candidates, ["doc_id", "sid"])
    blocks = in_block_pairs(grams, "comp", "size", VERIFY_BLOCK).select("pair", "side", "sid", "copies", "grams")
    verified = materialize(run_pairs(blocks, _verify(threshold), "sid long, links long, root long"), "links")
    classes = connected_components(verified.select(F.col("sid").alias("a"), F.col("root").alias("b")), "classes")
    classes = classes.select(F.col("node").alias("sid"), "root")
    links = verified.groupBy("sid").agg(F.sum("links").alias("links"))
    known = classes.join(links, "sid").join(sets.select("sid", "rep"), "sid")
    least = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(least, "root").select("sid", "class_id", "links", "root")
    of_set = sets.select("sid", "rep", "copies", F.col("n").alias("n_grams")).join(known, "sid", "left").select(
        "sid", F.coalesce("class_id", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "n_grams",
        F.coalesce("root", "sid").alias("class_key"),
    )
    done = signed.select("doc_id", "th", "sid").join(of_set, "sid").select("doc_id", "class_id", "n_links", "n_grams", "th", "class_key")
    no_word = own.where(F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    zero = no_word.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).alias("n_grams"), "th", F.lit(None).cast("long").alias("class_key"))
    return done.unionByName(zero)

