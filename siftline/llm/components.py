"""Connected components of an edge table, by alternating large-star and small-star steps.

Nothing is collected: each step is a join with an aggregate that combines before its shuffle, so a vertex with very many
neighbours is split by Spark's skew handling (the aggregated side has one row per vertex). Every step's edges are
written to the shared folder, which cuts lineage and survives lost executors; a step's table is deleted after the next.

Edge cases: edges with a null end and edges from a vertex to itself are left out, and repeated edges count once; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex ties its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex ties itself and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(low, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable. ``edges`` has u and v, any order."""
    edges = written(edges.select("u", "v").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == now or not now["n"]:
            break
        state = now
        before, edges = edges, written(_small_star(_large_star(edges)), "edges")
        discard(before)
    # a star around each root
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out.siftline_path = edges.siftline_path  # for discard()
    return out
