"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanframe.llm.common import release, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the ends of `edges` (a, b: long); a component is one of its nodes.

    Each round gives every node a rank, a hash of the node and the round, and every node points
    to its neighbour of least rank, if that is less than its own; pointers are followed twice, and edges
    between what remains go to the next round. About half of the nodes of a path or more vanish in a
    round, however the ids are ordered, so the rounds grow as the logarithm of the longest
    path. They are staged in the shared folder and released; the driver sees counts only. A
    hot node is summed before it is shuffled.
    """
    edges = staged(edges.select("a", "b").where("a <> b"), "edges")
    labels, turn = None, 0
    while labels is None or not edges.isEmpty():
        ranked = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("r"), F.col(c).alias("v"))      # noqa: E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(ranked("a"), F.min(ranked("b")))["v"].alias("p"))
                       .withColumnRenamed("a", "node"), "least")
        up = least.select(F.col("node").alias("p"), F.col("p").alias("q"))
        roots = staged(least.join(up, "p").select("node", F.col("q").alias("root")), "roots")
        release(least)
        old, done = labels, edges
        if old is None:
            labels = roots.select("node", F.col("root").alias("component"))
        else:
            moved = roots.withColumnsRenamed({"node": "component"})
            labels = old.join(moved, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component"))
        labels = staged(labels, "labels")
        at = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))      # noqa: E731
        edges = staged(done.join(at("a"), "a").join(at("b"), "b").where("_a <> _b")
                       .select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges")
        release(roots, done, *([old] if old is not None else []))
        turn += 1
    release(edges)
    return labels
