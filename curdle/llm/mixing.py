"""Mixing sources to target weights by temperature.

The weight of a source is its token share to the power of an exponent between 0
(uniform) and 1 (as it is), normalised. The exponent is the largest that meets the
target entropy, given as a share of the largest possible, unless drawing by it would
repeat a source more often than ``max_repeats``; then it is the smallest that keeps to
that limit. Both come from bisection. A round of it is one job over the table of
sources that sums up 15 points inside the current interval (four halvings), so the
sources are never gathered, however many there are.

The budget is the number of tokens at which the source with the largest ratio of share
to weight is drawn exactly once: mixing takes no document away and repeats the others.

Each source's budget is realised as block permutations. Every epoch deals a source's
documents by hash into blocks of about ``block_tokens`` and puts blocks, and documents
within them, in a hashed order. Whole epochs are taken in full; the last one up to the
budget: blocks before the cut in full, and of the block that holds it the documents
that begin before it. Only those blocks' documents are ever sorted.

Nulls and odd rows: a null source is a source of its own; a document without a word
(null or empty text) has no tokens and is drawn once; rows with the same id and text
are drawn alike; other columns are kept, but for ``epoch``, ``block`` and ``order``
and names that begin with an underscore, which are the operator's; an empty
table gives an empty result. A corpus without tokens, or with one source, is drawn once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curdle.operators.materialize import materialize

ENTROPY = 0.95
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
POINTS, ROUNDS = 15, 8


def n_tokens(text: str = "text") -> Column:
    """Words of the text."""
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _measure(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, most repeats) of the weights at each exponent, in one pass over the sources."""
    p = F.col("tokens") / F.lit(float(total))
    columns = []
    for i, a in enumerate(exponents):
        w = F.pow(p, F.lit(a))
        columns += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(p) * a).alias(f"l{i}"), F.max(w / p).alias(f"x{i}"), F.min(w / p).alias(f"y{i}")]
    r = sources.agg(*columns).first()
    # Entropy of w / z; repeats when the least repeated source is drawn once.
    return [(math.log(r[f"z{i}"]) - r[f"l{i}"] / r[f"z{i}"], r[f"x{i}"] / r[f"y{i}"]) for i in range(len(exponents))]


def temperature(sources: DataFrame, entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """The exponent for a table of sources (tokens > 0)."""
    r = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not r["t"] or r["n"] < 2:
        return 1.0
    target = entropy * math.log(r["n"])

    def boundary(holds) -> float:
        """The exponent where a condition that is true below it turns false (1 if it never does)."""
        if holds(_measure(sources, r["t"], [1.0])[0]):
            return 1.0
        lo, hi = 0.0, 1.0
        for _ in range(ROUNDS):
            inner = [lo + (hi - lo) * (i + 1) / (POINTS + 1) for i in range(POINTS)]
            ok = [a for a, m in zip(inner, _measure(sources, r["t"], inner)) if holds(m)]
            lo = max(ok, default=lo)
            hi = min((a for a in inner if a > lo), default=hi)
        return lo

    even = boundary(lambda m: m[0] >= target)
    # Repeats fall as the exponent grows: the condition is true above its boundary.
    limit = boundary(lambda m: m[1] > max_repeats)
    if _measure(sources, r["t"], [even])[0][1] <= max_repeats:
        return even
    return min(1.0, limit + 2.0 ** (-4 * ROUNDS))


def _hash(*cols) -> Column:
    return F.xxhash64(*cols)


def mix(
    docs: DataFrame,
    source: str = "source",
    id_col: str = "doc_id",
    text: str = "text",
    entropy: float = ENTROPY,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The drawn rows: the columns of ``docs`` and epoch (from 0), block and order (sort by epoch, block, order within a source)."""
    names = [c for c in docs.columns if c not in ("epoch", "block", "order")]
    lean = docs.select(F.col(id_col).alias("_id"), F.col(source).alias("_source"), F.xxhash64(F.col(text).cast("string")).alias("_th"), n_tokens(text).alias("_n"))
    lean = materialize(lean, "mix-sizes")
    sources = materialize(lean.where("_n > 0").groupBy("_source").agg(F.sum("_n").alias("tokens")), "mix-sources")
    exponent = temperature(sources, entropy, max_repeats)
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    ratio = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent - 1.0))
    least = sources.agg(F.min(ratio)).first()[0] or 1.0
    # Repeats of a source, in millionths, so that equal runs give equal budgets.
    plan = sources.withColumn("_repeats", F.round(ratio / F.lit(least), 6)).select(
        F.col("_source").alias("_s"), F.floor("_repeats").cast("int").alias("_whole"),
        F.floor((F.col("_repeats") - F.floor("_repeats")) * F.col("tokens")).cast("long").alias("_rest"),
        F.greatest(F.lit(1).cast("long"), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("_blocks"),
    )

    def order_of(epoch: Column) -> Column:
        return _hash("_id", "_th", epoch, F.lit(seed))

    def block_of(epoch: Column) -> Column:
        # The block's number is hashed, so numbers are already in a permuted order of the epoch and source.
        return _hash(F.pmod(_hash("_th", "_id", epoch, F.lit(seed + 1)), "_blocks"), "_source", epoch, F.lit(seed))

    sized = lean.where("_n > 0").join(plan, F.col("_source").eqNullSafe(F.col("_s"))).where("_rest > 0")
    last = sized.select("_id", "_source", "_th", "_n", "_rest", block_of(F.col("_whole")).alias("_block"), order_of(F.col("_whole")).alias("_order"))
    # Tokens of the last epoch's blocks, then the block of each source that the budget ends in.
    of_block = last.groupBy("_source", "_block").agg(F.sum("_n").alias("_t"), F.first("_rest").alias("_rest"))
    before = F.sum("_t").over(Window.partitionBy("_source").orderBy("_block")) - F.col("_t")
    cut = of_block.withColumn("_before", before).where("_before < _rest AND _before + _t >= _rest")
    cut = materialize(cut.select(F.col("_source").alias("_s"), F.col("_block").alias("_cut"), (F.col("_rest") - F.col("_before")).alias("_left")), "mix-cuts")
    inside = last.join(cut, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_cut")))
    running = Window.partitionBy("_source").orderBy("_order", "_id", "_th").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_run", F.coalesce(F.sum("_n").over(running), F.lit(0))).where("_run < _left")
    # The last document that begins before the cut; ties are rows with the same id and text.
    ends = inside.groupBy("_source").agg(F.max(F.struct("_order", "_id", "_th")).alias("_end"))
    plan = plan.join(cut.select(F.col("_s").alias("_s2"), "_cut"), F.col("_s").eqNullSafe(F.col("_s2")), "left").drop("_s2")
    plan = plan.join(ends.select(F.col("_source").alias("_s3"), "_end"), F.col("_s").eqNullSafe(F.col("_s3")), "left").drop("_s3")
    plan = materialize(plan, "mix-plan")

    # The input's columns travel as one, so that none can clash with those added here.
    some = F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    with_keys = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(id_col).alias("_id"), F.col(source).alias("_source"),
        F.xxhash64(F.col(text).cast("string")).alias("_th"), some.alias("_some"),
    )
    drawn = with_keys.join(plan, F.col("_source").eqNullSafe(F.col("_s")), "left")
    block, order = block_of(F.col("_whole")), order_of(F.col("_whole"))
    key = F.struct(order.alias("_order"), "_id", "_th")
    in_last = (F.col("_rest") > 0) & ((block < F.col("_cut")) | ((block == F.col("_cut")) & (key <= F.col("_end"))))
    times = F.when(F.col("_some") & F.col("_whole").isNotNull(), F.col("_whole") + F.coalesce(in_last, F.lit(False)).cast("int")).otherwise(F.lit(1))
    drawn = drawn.withColumn("_epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    return drawn.select(
        *[F.col("_row").getField(c).alias(c) for c in names], F.col("_epoch").alias("epoch"),
        F.coalesce(block_of(F.col("_epoch")), F.lit(0).cast("long")).alias("block"), order_of(F.col("_epoch")).alias("order"),
    )
