"""Connected components of an undirected graph, as repeated joins and aggregates.

Each round is a large-star and a small-star step: every node's larger neighbours, then its smaller
ones, are linked to the smallest node around it. The number of rounds grows with the logarithm of
the longest path. Every round is written below the shared folder, so the plan stays short and a
lost executor costs a re-read. A node's links are only ever aggregated or joined; no task gathers
them. What they are joined with is written first, so that Spark can split the links of a node with
very many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stage(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """From links ``u, v`` of ids to ``node, component``: each linked node's smallest reachable id."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage(down.filter("u <> v").distinct())
    state = None
    while True:
        new = stage(_small_star(_large_star(now)).distinct())
        # At the end every node is linked to its component's smallest; then a round changes nothing.
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = new
        if mark == state:
            break
        state = mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
