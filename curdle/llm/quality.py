"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms are trigrams over byte classes (capital, small letter, digit, space, each
kind of mark, ...), which are the same for every language, and repetition terms
(a word equal to the one before it, words in four-word windows that the text
repeats). A document is the vector of its terms' root shares times their idf, with
document frequencies over all rows. The labelled vectors' leading singular
directions (``DIMS``) span the latent space. Every document's exact cosines with
all labelled vectors are computed in blocks; the ``NEIGHBOURS`` nearest, and all as
near as the last of them, vote with their similarity, raised to ``SHARPNESS``, as weight.

``SAMPLE`` bounds the labelled rows that the model is fitted on (those with the
smallest hash of the id); the labelled vectors and the projection, both of a size
fixed by the parameters, are what the driver holds and broadcasts. Only rows on the
learning side of the split are read, and of them only text and label.

Nulls and odd rows: a text without a word (null or empty) gets the share of label 1
among the labelled rows; a null id is on the learning side but has no label; an id
with different labels is not learned from; a label that is neither 0 nor 1 is none;
repeated rows are scored each. Without any label all scores are 0.5. Other columns
of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curdle.llm import kernels as K

SAMPLE = 4096
DIMS = 48
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.7

#: Byte classes: 0 other control, 1 capital, 2 small, 3 digit, 4 space, 5 line end, 6 beyond ASCII, 7.. single marks.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[[*range(0x41, 0x5B)]] = 1
_CLASS[[*range(0x61, 0x7B)]] = 2
_CLASS[[*range(0x30, 0x3A)]] = 3
_CLASS[[0x20, 0x09]] = 4
_CLASS[[0x0A, 0x0D]] = 5
_CLASS[0x80:] = 6
for _i, _c in enumerate(".,!#*$%&|"):
    _CLASS[ord(_c)] = 7 + _i
_OTHER_MARK = [c for c in range(0x21, 0x7F) if _CLASS[c] == 0]
_CLASS[_OTHER_MARK] = 16
CLASSES = 17
TRIGRAMS = CLASSES**3
#: Repetition terms: a word like the one before, words in repeated four-word windows, and other words.
TERMS = TRIGRAMS + 3


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, count) of a slice, sorted by document and term."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    c = _CLASS[data]
    key = np.zeros(0, np.int64)
    if len(c) > 2:
        inside = doc[2:] == doc[:-2]
        key = ((doc[:-2] * TERMS + c[:-2] * CLASSES**2) + c[1:-1] * CLASSES + c[2:])[inside]
    _, _, h, first = K.words(data, offsets)
    of_word = np.repeat(np.arange(n), np.diff(first))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])
    w = K.window_hashes(h, 4)
    at = np.flatnonzero(K.whole(len(w), 4, first))
    order = at[np.lexsort((w[at], of_word[at]))]
    twin = np.zeros(len(w), dtype=bool)
    if len(order):
        equal = (w[order][1:] == w[order][:-1]) & (of_word[order][1:] == of_word[order][:-1])
        twin[order[1:][equal]] = twin[order[:-1][equal]] = True
    covered = np.zeros(len(h), dtype=bool)
    for i in range(4):
        covered[i : i + len(w)] |= twin
    repeat = of_word * TERMS + TRIGRAMS
    key = np.concatenate([key, repeat[same], repeat[covered] + 1, repeat[~covered] + 2])
    key, count = np.unique(key, return_counts=True)
    return key // TERMS, key % TERMS, count


def vectors(doc: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Dense unit vectors (n x terms) of idf times the root of each term's share; the two kinds of term share alike."""
    dense = np.zeros((n, len(idf)), dtype=np.float32)
    kind = (term >= TRIGRAMS).astype(np.int64)
    total = np.bincount(doc * 2 + kind, count, 2 * n)
    dense[doc, term] = np.sqrt(count / total[doc * 2 + kind]) * idf[term]
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    return dense / np.where(norm > 0, norm, 1)


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for a, b, data, offsets in K.text_slices(batch.column(0)):
            _, term, _ = term_counts(data, offsets)
            df += np.bincount(term, minlength=TERMS)
            n += b - a
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int32()), pa.array([*df[some], n], pa.int64())], names=["term", "n"])


class Model:
    """idf, projection (terms x dims), labelled latent unit vectors and their labels."""

    def __init__(self, idf, projection, points, labels) -> None:
        self.idf, self.projection, self.points, self.labels = idf, projection, points, labels
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.projection
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        return z / np.where(norm > 1e-9, norm, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        cosine = np.round(self.latent(x) @ self.points.T, 5)
        # All rows as near as the k-th nearest vote, so ties are never broken.
        least = np.partition(cosine, -k, axis=1)[:, -k]
        doc, near = np.nonzero(cosine >= least[:, None])
        weight = np.maximum(cosine[doc, near], 0).astype(np.float64) ** SHARPNESS
        total = np.bincount(doc, weight, len(x))
        some = total > 0
        out[some] = np.bincount(doc, weight * self.labels[near], len(x))[some] / total[some]
        return np.round(out, 6)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Document frequencies over all of ``docs``, then the latent space from at most ``sample`` labelled rows."""
    texts = docs.select(F.col(text).cast("string").alias("t"))
    # One row a term at most: the vocabulary is fixed.
    counted = texts.mapInArrow(_document_frequency, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = {r["term"]: r["n"] for r in counted}
    n_docs = df.pop(-1, 0)
    idf = np.full(TERMS, np.log(1.0 + n_docs))
    for t, n in df.items():
        idf[t] = np.log((1.0 + n_docs) / (1.0 + n)) + 0.1
    chosen = (
        labels.where(~held_out(id_col) & F.col(label).isin(0, 1)).groupBy(id_col)
        .agg(F.min(label).alias("y"), F.max(label).alias("y2")).where(F.col("y") == F.col("y2"))
        .select(F.col(id_col).alias("_id"), "y").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in K.text_slices(batch.column(1)):
                doc, term, count = term_counts(data, offsets)
                per_doc = np.bincount(doc, minlength=b - a)
                cut = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[a:b], batch.column(2)[a:b],
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(count, pa.int32())),
                    ],
                    names=["_id", "y", "term", "n"],
                )

    # The chosen ids are at most ``sample`` rows, so they may be broadcast.
    learn = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("t")).join(F.broadcast(chosen), "_id")
    id_type = learn.schema["_id"].dataType.simpleString()
    rows = (
        learn.select("_id", "t", F.col("y").cast("int").alias("y")).mapInArrow(run, f"_id {id_type}, y int, term array<int>, n array<int>")
        .orderBy(F.xxhash64("_id"), "_id", F.xxhash64("term", "n")).limit(sample).toArrow()
    )
    rows = rows.filter(pc.greater(pc.list_value_length(rows["term"]), 0))
    y = rows["y"].to_numpy().astype(np.float64)
    if not len(y):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y)
    doc = np.repeat(np.arange(len(y)), pc.list_value_length(rows["term"]).to_numpy())
    x = vectors(doc, pc.list_flatten(rows["term"]).to_numpy(), pc.list_flatten(rows["n"]).to_numpy(), len(y), idf)
    projection = _directions(x, min(DIMS, *x.shape))
    model = Model(idf, projection, None, y)
    model.points = model.latent(x).astype(np.float32)
    return model


def _directions(x: np.ndarray, k: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    g = np.random.Generator(np.random.PCG64(7)).standard_normal((x.shape[1], min(x.shape[1], k + 16))).astype(np.float32)
    for _ in range(6):
        g = np.linalg.qr(x.T @ (x @ g))[0]
    _, _, v = np.linalg.svd(x @ g, full_matrices=False)
    return np.ascontiguousarray((g @ v.T)[:, :k], dtype=np.float32)


def classify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, score and predicted of every row; a block of documents at a time."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # SAMPLE x DIMS and TERMS x DIMS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shipped.value
        for batch in batches:
            scores = []
            for a, b, data, offsets in K.text_slices(batch.column(len(keep))):
                doc, term, count = term_counts(data, offsets)
                for lo in range(0, b - a, 256):
                    hi = min(lo + 256, b - a)
                    i, j = np.searchsorted(doc, [lo, hi])
                    x = vectors(doc[i:j] - lo, term[i:j], count[i:j], hi - lo, m.idf)
                    scores.append(m.score(x))
            if scores:
                s = np.concatenate(scores)
                out = [*batch.columns[: len(keep)], pa.array(s), pa.array((s >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "score", "predicted"])

    picked = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{kept}score double, predicted int")
