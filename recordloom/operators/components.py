"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordloom.operators.skew import HOT_ROWS, heavy_keys, split_join
from recordloom.session import cut_lineage

MAX_ROUNDS = 100


def numbered(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, id`` of all ends of ``pairs (a, b)``, ids in the order of nodes; and the pairs as ids, larger first.

    Ranges of nodes are sorted and numbered, so that the least id is the least node, and stored,
    so that a number never changes. The steps then move two longs an edge, whatever the ids are.
    """
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = ends.repartitionByRange("node").sortWithinPartitions("node").select("node", F.monotonically_increasing_id().alias("id"))
    nodes = cut_lineage(nodes, "nodes")
    # both inputs of these joins are read from tables, so adaptive execution splits a hub's rows
    coded = pairs.join(nodes.withColumnsRenamed({"node": "a", "id": "x"}), "a").join(nodes.withColumnsRenamed({"node": "b", "id": "y"}), "b")
    return nodes, coded.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _to_least(directed: DataFrame, hot_rows: int, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """Edges with the least neighbour of their first node, and ``a, low`` by itself.

    Map tasks sum up a hub before the shuffle, and its edges are split in the join. Fewer edges
    than a hub has need no search for hubs.
    """
    low = directed.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("degree"))
    least = low.select("a", "low")
    if n_rows < hot_rows:
        return directed.join(least, "a"), least
    return split_join(directed, least, "a", heavy_keys(low, "a", "degree", hot_rows), ["b"]), least


def _large_star(edges: DataFrame, hot_rows: int, n_edges: int) -> DataFrame:
    """Connect every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = _to_least(both, hot_rows, 2 * n_edges)
    return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("low", "a").alias("b")).distinct()


def _small_star(edges: DataFrame, hot_rows: int, n_edges: int) -> DataFrame:
    """Connect a node and its smaller neighbours to the least of them; ``edges`` have the larger end first."""
    joined, low = _to_least(edges, hot_rows, n_edges)
    moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(low.select("a", F.col("low").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, left: str, right: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(node, component)`` for every node that has an edge; the component is its least node.

    Nodes are numbered once. The edge set shrinks towards one star per component in O(log^2 n)
    rounds. Each step is an aggregation with map-side combining and a join against one row per
    node, in which the edges of a node of very high degree are split, so a hub is never a collected
    group nor one task. Rounds are cut by a table in the shared folder, which a lost executor does
    not take with it.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where(F.col("a") != F.col("b"))
    nodes, coded = numbered(cut_lineage(pairs.distinct(), "pairs"))
    stars = cut_lineage(coded, "edges")
    before = _signature(stars)
    for round_number in range(MAX_ROUNDS):
        stars = cut_lineage(_small_star(_large_star(stars, hot_rows, before[0]), hot_rows, before[0]), f"round{round_number}")
        after = _signature(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    members = stars.unionAll(stars.select(F.col("b").alias("a"), "b").distinct())
    sizes = members.groupBy("b").agg(F.count(F.lit(1)).alias("size"))
    centres = nodes.select(F.col("id").alias("b"), F.col("node").alias("component"))
    named = members.join(nodes.withColumnRenamed("id", "a"), "a").select("node", "b")
    return split_join(named, centres, "b", heavy_keys(sizes, "b", "size", hot_rows), ["node"]).select("node", "component")
