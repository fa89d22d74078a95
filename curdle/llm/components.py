"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is a minimum per node (with partial aggregation) joined back to the
edges, so a hub with a third of all edges is summed up before it moves and its
join partition can be split. Rounds are written to the shared checkpoint folder, each
removed when the next one stands; two counts a round are all that the driver sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curdle.operators.materialize import discard, materialize, release_later, stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of an edge (a, b), root the smallest node of its component. Loops are nodes without edges."""
    # Written first: nodes and edges are read from the same rows, however dear these were.
    edges = materialize(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), name)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = edges.where("a <> b")
    state, path = _state(now), None
    while state[0]:
        now, new = stage(_small_star(_large_star(now)), name)
        before, state = state, _state(now)
        if path:
            discard(edges.sparkSession, path)
        path = new
        if state == before:
            break
    if path:
        release_later(edges.sparkSession, path)
    # Stars remain: every node but the roots has one edge, to its root.
    return nodes.join(now, nodes["node"] == now["a"], "left").select("node", F.coalesce("b", "node").alias("root"))
