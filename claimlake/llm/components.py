"""Connected components of an edge table by alternating star contraction.

Large-star: every node points its larger neighbours at its smallest one.
Small-star: every node points its smaller neighbours, and itself, at the
smallest of them.  Both are a grouped minimum (combined map-side) joined back to
the edges, so a node with very many neighbours is split by the skew join and no
component is ever gathered in one task.  Rounds end when the edges, compared by
count and hash sums, no longer change: then every edge points at its root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low.withColumnRenamed("a", "__n"), F.col("a") == F.col("__n")).drop("__n")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b of any orderable type) -> (node, root), root the smallest
    node reachable; nodes without edges do not appear."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "components")
    state = _state(edges)
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _star(both, low).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (_star(large, low).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialise(small, "components")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
