"""Quality rules: text statistics and robust multivariate outliers (minimum covariance determinant).

Every document gets counts over its whole text, then a vector of five transformed
statistics. For each (lang, source) group an MCD estimate is found by concentration
steps: from the coordinate-wise median and MAD, take the half (``SUPPORT``) of the
group's documents that lie closest, re-estimate mean and covariance from them, and
repeat; so junk of one kind may make up nearly half of a group before it draws the
estimate towards it. A last estimate rests on all documents that the half finds
usual (``USUAL``). A step is two aggregations with partial sums, so a group that holds a third
of all rows costs no more than any other; quantiles are taken on a fixed grid, so
they are exact, bounded in memory and the same in every run. Documents whose squared
Mahalanobis distance exceeds ``CUTOFF`` are rejected.

Estimates use the documents that pass the base rules. A group with fewer than
``MIN_GROUP`` of them is pooled with the other such groups of its language, then of
the corpus; where even that is too small there is no estimate and documents that
pass the base rules are kept.

Nulls and odd rows: a null or empty text has no words (and fails the base rules);
null lang or source are groups of their own; repeated rows are judged each; other
columns of the input are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curdle.llm import kernels as K
from curdle.operators.materialize import materialize

#: Share of a group's documents that an estimate rests on.
SUPPORT = 0.5
#: Factor from the covariance of the closest half to that of all, for five normal dimensions.
CONSISTENCY = 1.912
#: Squared distance up to which a document counts for the last estimate (97.5 % of five normal dimensions), and its factor.
USUAL, USUAL_CONSISTENCY = 12.833, 1.056
#: Squared distance beyond which a document is an outlier (chi-square, five degrees of freedom, about 1 in 10^6).
CUTOFF = 36.0
MIN_GROUP = 100
STEPS = 4
DIMS = 5
#: Least standard deviation of each statistic: a difference below this means nothing, however tight a group is.
#: Each statistic's range is more than sqrt(CUTOFF) of its floors, so it can reject alone: in a group that has none,
#: above 2.3 symbols per 100 words, 36 % duplicate lines or 24 % repeated words.
FLOOR = (0.5, 0.5, 0.2, 0.1, 0.04)
#: Grid steps per unit, for the statistics and for ln(1 + squared distance).
GRID, DISTANCE_GRID = 64.0, 256.0

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def _seen_before(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: an equal value stands earlier in the same owner; it stands there at all, more than once."""
    later, many = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    if len(owner):
        order = np.lexsort((value, owner))  # stable: equal entries keep their order
        same = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
        later[order[1:][same]] = True
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
    return later, many


def slice_stats(data: np.ndarray, offsets: np.ndarray, window: int = 8) -> list[np.ndarray]:
    """The six counts for each document of a slice."""
    n = len(offsets) - 1
    starts, ends, h, first = K.words(data, offsets)
    doc_of_word = np.repeat(np.arange(n), np.diff(first))
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n_words = np.diff(first)
    word_chars = np.bincount(doc_of_word, point[ends] - point[starts], n).astype(np.int64)
    symbol = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    n_symbols = symbol[offsets[1:]] - symbol[offsets[:-1]]
    # Lines with a word: their identity is the hash of the whole line.
    l_start, l_end = K.runs(data != 0x0A, offsets)
    has_word = np.searchsorted(starts, l_end) > np.searchsorted(starts, l_start)
    l_start, l_end = l_start[has_word], l_end[has_word]
    doc_of_line = np.searchsorted(offsets, l_start, side="right") - 1
    later, _ = _seen_before(doc_of_line, K.span_hashes(data, l_start, l_end))
    n_lines = np.bincount(doc_of_line, minlength=n)
    n_dup = np.bincount(doc_of_line[later], minlength=n)
    w = K.window_hashes(h, window)
    at = np.flatnonzero(K.whole(len(w), window, first))
    _, many = _seen_before(doc_of_word[at], w[at])
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, at[many], 1)
    np.add.at(cover, at[many] + window, -1)
    n_repeat = np.bincount(doc_of_word[np.cumsum(cover)[:-1] > 0], minlength=n)
    return [n_words, word_chars, n_symbols, n_dup, n_lines, n_repeat]


def text_stats(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` columns and the counts of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slice_stats(data, offsets) for _, _, data, offsets in K.text_slices(batch.column(len(keep)))]
            if found:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=names)

    picked = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    names = [*keep, *(s.split()[0] for s in STATS.split(", "))]
    return picked.mapInArrow(run, f"{kept}, {STATS}")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics x0 .. x4: document length, word length, symbols, duplicate lines, repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.col("word_chars") / n,
        F.log1p(100.0 * F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / lines),
        F.col("n_repeat_words") / n,
    ]


X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
_PARAMS = "g string, " + ", ".join(f"m{i} double" for i in range(DIMS)) + ", " + ", ".join(f"p{i}{j} double" for i, j in PAIRS)


def _distance() -> Column:
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + F.col(f"p{i}{j}") * d[i] * d[j] * (1.0 if i == j else 2.0)
    return total


def _grid_distance() -> Column:
    return F.rint(F.log1p(F.greatest(_distance(), F.lit(0.0))) * DISTANCE_GRID)


def _start(points: DataFrame) -> DataFrame:
    """Median and MAD of each statistic and group, as a diagonal precision matrix."""
    rounded = [F.rint(F.col(x) * GRID).alias(x) for x in X]
    cells = points.select("g", *rounded)
    medians = cells.groupBy("g").agg(*[F.percentile(x, F.lit(0.5)).alias(f"c{i}") for i, x in enumerate(X)])
    spread = cells.join(medians, "g").groupBy("g").agg(
        *[F.first(f"c{i}").alias(f"c{i}") for i in range(DIMS)],
        *[F.percentile(F.abs(F.col(x) - F.col(f"c{i}")), F.lit(0.5)).alias(f"d{i}") for i, x in enumerate(X)],
    )
    scale = [F.greatest(F.col(f"d{i}") * 1.4826 / GRID, F.lit(FLOOR[i])) for i in range(DIMS)]
    return spread.select(
        "g",
        *[(F.col(f"c{i}") / GRID).alias(f"m{i}") for i in range(DIMS)],
        *[(1.0 / (scale[i] * scale[i]) if i == j else F.lit(0.0)).alias(f"p{i}{j}") for i, j in PAIRS],
    )


def _invert(batches: Iterator[pa.RecordBatch], consistency: float) -> Iterator[pa.RecordBatch]:
    """Core sums of each group to its mean and precision matrix."""
    unit = np.array(FLOOR)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            mean = np.array([r[f"s{i}"] for i in range(DIMS)]) / r["n"]
            cov = np.zeros((DIMS, DIMS))
            for i, j in PAIRS:
                cov[i, j] = cov[j, i] = r[f"q{i}{j}"] / r["n"] - mean[i] * mean[j]
            # The core is the tightest part of the group: scale its spread up to that of the whole. In units of the
            # floors, no direction has a variance below 1; wider directions stay as they are.
            wide, axes = np.linalg.eigh(np.round(cov, 9) * consistency / np.outer(unit, unit))
            precision = (axes / np.maximum(wide, 1.0)) @ axes.T / np.outer(unit, unit)
            rows.append({"g": r["g"]} | {f"m{i}": float(mean[i]) for i in range(DIMS)} | {f"p{i}{j}": float(precision[i, j]) for i, j in PAIRS})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("g", pa.string()), *[(n.split()[0], pa.float64()) for n in _PARAMS.split(", ")[1:]]]))


def _estimate(core: DataFrame, consistency: float) -> DataFrame:
    # Sums of fixed-point values are the same in whatever order tasks end.
    whole = lambda c: F.sum(F.rint(c * 1e6).cast("decimal(28,0)")).cast("double") / 1e6
    sums = core.groupBy("g").agg(
        F.count("*").alias("n"),
        *[whole(F.col(x)).alias(f"s{i}") for i, x in enumerate(X)],
        *[whole(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in PAIRS],
    )
    return sums.mapInArrow(lambda batches: _invert(batches, consistency), _PARAMS)


def _concentrate(points: DataFrame, params: DataFrame) -> DataFrame:
    near = points.join(params, "g").select("g", *X, _grid_distance().alias("d"))
    bar = near.groupBy("g").agg(F.percentile("d", F.lit(SUPPORT)).alias("bar"))
    return _estimate(near.join(bar, "g").where(F.col("d") <= F.col("bar")), CONSISTENCY)


def _reweight(points: DataFrame, params: DataFrame) -> DataFrame:
    usual = points.join(params, "g").where(F.exp(_grid_distance() / DISTANCE_GRID) - 1 <= USUAL)
    return _estimate(usual.select("g", *X), USUAL_CONSISTENCY)


def _with_group(points: DataFrame) -> DataFrame:
    """Add ``g``: (lang, source), or the pool of small groups of the language, or of the corpus."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    points = points.withColumn("_l", part("lang")).withColumn("_s", part("source"))
    own = points.where(~F.col("base_failed")).groupBy("_l", "_s").agg(F.count("*").alias("n"))
    all_groups = points.select("_l", "_s").distinct().join(own, ["_l", "_s"], "left").fillna(0, ["n"])
    small = all_groups.where(F.col("n") < MIN_GROUP).groupBy("_l").agg(F.sum("n").alias("n_lang"))
    level = (
        all_groups.join(small, "_l", "left")
        .select(
            "_l", "_s",
            F.when(F.col("n") >= MIN_GROUP, F.to_json(F.struct("_l", "_s")))
            .when(F.col("n_lang") >= MIN_GROUP, F.to_json(F.struct("_l")))
            .otherwise(F.lit("{}")).alias("g"),
        )
    )
    return points.join(level, ["_l", "_s"]).drop("_l", "_s")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, distance (null without an estimate) and kept for every row of ``docs``."""
    stats = text_stats(docs).withColumn("base_failed", base_failed())
    points = materialize(_with_group(stats.select("*", *[c.alias(x) for x, c in zip(X, vector())])), "mcd-points")
    fit = points.where(~F.col("base_failed")).select("g", *X)
    enough = fit.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_GROUP).select("g")
    fit = fit.join(enough, "g", "left_semi")
    params = materialize(_start(fit), "mcd-params")
    for _ in range(STEPS):
        params = materialize(_concentrate(fit, params), "mcd-params")
    params = materialize(_reweight(fit, params), "mcd-params")
    judged = points.join(params, "g", "left").withColumn("distance", F.when(F.col("m0").isNotNull(), _grid_distance() / DISTANCE_GRID))
    kept = ~F.col("base_failed") & F.coalesce(F.exp("distance") - 1 <= CUTOFF, F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round("distance", 6).alias("distance"), kept.alias("kept"),
    )
