"""Connected components of a large edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (u, v), u > v.

    Large-star links each larger neighbour of a node to the smallest of its
    neighbourhood, small-star each smaller one. The minimum is an aggregate
    that combines before it shuffles, and joins back on a unique key.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): each node of the edges and the smallest node of its component.

    Alternating large-star and small-star steps, each pair written to the shared
    folder; the rounds grow with the logarithm of the longest chain. Self-loops
    and nulls are no edges.
    """
    now = edges.where(f"{a} != {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, last = materialize(now, "edges"), None
    for _ in range(most_rounds):
        seen = now.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        if last == seen or not seen.n:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last, before = seen, now
        now = materialize(_star(_star(now, True), False), "edges")
        release(before)
    raise RuntimeError("components did not settle")
