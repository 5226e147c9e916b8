"""Connected components of an edge table, by DataFrame operations only.

Each round hooks every node to the best of its closed neighbourhood and contracts the graph to the nodes hooked to.
Rounds take turns between the smallest id, which finishes stars at once, and the smallest salted hash, under which any
graph is expected to shrink by a constant factor. Mappings and contracted edges are written to the shared folder each
round, so a lost executor costs one round at most; nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut, release


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); component is the smallest node that can be reached."""
    edges = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        before = edges
        both = edges.select("a", "b").union(edges.select("b", "a"))
        if len(steps) % 2 == 0:
            hooks = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("rep"))
        else:
            rank = lambda c: F.xxhash64(F.lit(len(steps)), c)
            best = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("b"))).alias("m"))
            hooks = best.select(F.col("a").alias("node"), F.when(F.col("m.r") < rank("a"), F.col("m.b")).otherwise(F.col("a")).alias("rep"))
        hooks = cut(hooks, "hooks")
        steps.append(hooks)
        left = edges.join(hooks.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
        left = left.join(hooks.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b").where("ra <> rb")
        edges = cut(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        release(before)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = steps[-1].select("node", F.col("rep").alias("last"))
    for hooks in reversed(steps[:-1]):
        after = found.select(F.col("node").alias("rep"), "last")
        found = hooks.join(after, "rep", "left").select("node", F.coalesce("last", "rep").alias("last"))
    found = cut(found, "found")
    release(edges, *steps)
    # Written, so that both sides of the join below are plain scans, whose large partitions Spark can split.
    least = cut(found.groupBy("last").agg(F.min("node").alias("component")), "least")
    return found.join(least, "last").select("node", "component")
