"""Connected components by contraction: no hot vertex is ever gathered into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node.

    ``edges`` has LONG columns ``a`` and ``b``; the result has ``node`` and ``component`` for every
    node that has an edge to another. Null ends and self loops are ignored; no edges give no rows.
    Each round hooks every node to its smallest neighbour (an aggregate with map-side combine), halves
    the pointer chains and contracts the graph, so a star or a chain of stars ends in two or three rounds.
    """
    e = scratch.save(edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    for _ in range(rounds):
        if e.isEmpty():
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        p = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("p"))
        p = scratch.save(p)
        q = p.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        hop = scratch.save(p.join(q, "p").select("node", F.col("pp").alias("p")))
        left = hop.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        right = hop.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        nxt = e.join(left, "a").join(right, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        nxt = scratch.save(nxt)
        if labels is None:
            new = hop.select("node", F.col("p").alias("component"))
        else:
            new = labels.join(hop.select(F.col("node").alias("component"), F.col("p").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            new = scratch.save(new)
            scratch.drop(labels)
        scratch.drop(p, e)
        labels, e = new, nxt
    else:
        raise RuntimeError("components did not settle")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
