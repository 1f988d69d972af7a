"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordloom.llm.tables import cut_lineage

MAX_ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each end of ``edges (a long, b long)``; a component is named by its smallest node.

    In each round every node points to the smallest of itself and its neighbours and the graph is
    contracted along these pointers, which keeps it connected; a star is done in one round. The
    pointers of all rounds are joined at the end. The only aggregates are minima with map-side
    combining. Both sides of each join are read from written tables, so adaptive execution can
    split a hub's rows. Nothing is collected but the emptiness of the rest.
    """
    left = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "llm-edges")
    hops = []
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        both = left.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("near")))
        hop = cut_lineage(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("to")), "llm-hop")
        hops.append(hop)
        ends = left.join(hop.withColumnsRenamed({"node": "a", "to": "x"}), "a").join(hop.withColumnsRenamed({"node": "b", "to": "y"}), "b")
        left = cut_lineage(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "llm-edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    if not hops:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    final = hops[-1].withColumnRenamed("to", "component")
    for hop in reversed(hops[:-1]):
        after = final.withColumnsRenamed({"node": "to", "component": "further"})
        final = cut_lineage(hop.join(after, "to", "left").select("node", F.coalesce("further", "to").alias("component")), "llm-component")
    return final
