"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.sources.scratch import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(a, b) -> (node, component), component being the smallest node that is reachable.

    Each round links every larger neighbour of a node to the smallest one
    (large star), then every smaller neighbour (small star), until the graph is
    a set of stars: rounds grow with the logarithm of the longest path.  Minima
    are aggregated before they are joined back, so a node with very many
    neighbours is never one group in one task; its join is an equi-join that
    adaptive execution may split.  Self-loops give nodes of their own; null
    ends are left out; an empty table has no components.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    star = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    star = scratch.put(star, "r0")
    for k in range(1, max_rounds + 1):
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = star.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # an edge (u, v) with u larger: v's larger neighbour u goes to the smallest neighbour of v
        large = large.where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        nxt = scratch.put(small.where("u <> v").distinct(), f"r{k}")
        scratch.drop(f"r{k - 1}")
        star = nxt
        # stars: every node has one edge as the larger end, or only edges as the smaller end
        ends = nxt.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(nxt.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up > 0 and down > 0)").limit(1).count():
            break
    else:
        raise RuntimeError("components did not converge")
    out = nodes.join(star.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left")
    return scratch.put(out.select("node", F.coalesce("component", "node").alias("component")), "components")
