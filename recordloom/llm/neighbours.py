"""Nearest neighbours: a graph by NN-descent, queries by greedy graph search, confirmed on all vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordloom.llm.mixture import running
from recordloom.llm.tables import Scratch, cut_lineage
from recordloom.llm.vector_blocks import Arrays, arrow_rows, matrix, meet, pack, unpack

#: Neighbours of a node in the graph; as many reverse ones take part in joins and searches.
DEGREE = 16
TREES, BLOCK = 4, 256
#: NN-descent ends when a round changes at most this share of the lists.
SETTLED = 0.02
#: A local join gives each member its so many nearest in the group that beat what it has.
OFFERS = 6
#: Length of a query's list of nearest nodes, and nodes that every search starts from.
BEAM, ENTRIES, STEPS = 40, 16, 24
#: Nodes of a block and queries of a chunk that meet in the check, queries measured side by side, and pairs.
CHECK_NODES, CHECK_QUERIES, CHECK_ROWS, CHECK_PAIRS = 8192, 1024, 256, 1 << 16
_SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec`` of the rows that take part: id and vector not null, all components finite, not all zero.
    Of several dimensions the most common takes part."""
    rows = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    rows = rows.where(fine)
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (common[0] if common else 0))


def distance(a: str, b: str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _rows(small: pd.Series, dimension: int) -> np.ndarray:
    """Vectors stored with 4 or 8 bytes a component, in double precision."""
    data = b"".join(small)
    kind = np.float32 if len(data) == 4 * dimension * len(small) else np.float64
    return np.frombuffer(data, dtype=kind).reshape(len(small), dimension).astype(np.float64)


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances within each group of ``(groups, size, dimension)``; small ones that the
    matrix product would lose to cancellation are measured by differences."""
    n = (x * x).sum(axis=2)
    both = n[:, :, None] + n[:, None, :]
    d = both - 2 * x @ x.transpose(0, 2, 1)
    g, a, b = np.nonzero(d <= 1e-6 * both)
    for i in range(0, len(g), 1 << 16):
        at, c, e = g[i:i + (1 << 16)], a[i:i + (1 << 16)], b[i:i + (1 << 16)]
        d[at, c, e] = ((x[at, c] - x[at, e]) ** 2).sum(axis=1)
    return d


def nearest_rows(edges: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` rows of smallest ``d`` of each ``by``; map tasks drop the others before the shuffle."""
    other = "near" if by == "node" else "node"
    order = Window.partitionBy(by).orderBy("d", other)
    return edges.select("node", "near", "d", F.row_number().over(order).alias("place")).where(F.col("place") <= k).drop("place")


def middle_of(nodes: DataFrame) -> np.ndarray:
    """Median of each component, which no few far vectors move; approximate in rank only."""
    found = nodes.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.percentile_approx("x", 0.5, 1000).alias("m"))
    return found.orderBy("i").toArrow().column("m").to_numpy()


def start_graph(nodes: DataFrame, dimension: int, middle: np.ndarray) -> DataFrame:
    """Neighbours within blocks of nodes that lie on the same sides of random hyperplanes.

    Nodes are ranked by their sides, tree by tree, and cut into blocks of ``BLOCK``, so no block
    outgrows that however the vectors are spread.
    """
    planes = np.random.default_rng(_SEED).normal(size=(TREES, 24, dimension))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column("vec").to_numpy(zero_copy_only=False)) - middle
            for t in range(TREES):
                code = ((x @ planes[t].T > 0) @ (1 << np.arange(23, -1, -1))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(code), batch.column("node"), batch.column("small")], names=["tree", "code", "node", "small"])

    coded = nodes.select("node", "vec", "small").mapInArrow(sides, "tree int, code long, node long, small binary")
    coded = coded.withColumn("part", F.shiftright("code", 12)).withColumn("one", F.lit(1))
    placed = running(cut_lineage(coded, "llm-sides"), ["tree"], "part", "one", [F.col("code"), F.col("node")])

    def within(group: pd.DataFrame) -> pd.DataFrame:
        d = _squares(_rows(group["small"], dimension)[None])[0]
        np.fill_diagonal(d, np.inf)
        k = min(DEGREE, len(d) - 1)
        if k < 1:
            return pd.DataFrame({"node": [], "near": [], "d": []})
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        ids = group["node"].to_numpy()
        return pd.DataFrame({"node": np.repeat(ids, k), "near": ids[best].ravel(), "d": np.take_along_axis(d, best, axis=1).ravel().astype(np.float64)})

    blocks = placed.withColumn("block", F.floor(F.col("start") / BLOCK))
    found = blocks.select("tree", "block", "node", "small").groupBy("tree", "block").applyInPandas(within, "node long, near long, d double")
    return cut_lineage(nearest_rows(found.groupBy("node", "near").agg(F.min("d").alias("d")), "node", DEGREE), "llm-graph")


def _both_ways(graph: DataFrame) -> DataFrame:
    """``node, near`` over forward edges and each node's nearest reverse ones."""
    back = nearest_rows(graph, "near", DEGREE).select(F.col("near").alias("node"), F.col("node").alias("near"))
    return graph.select("node", "near").unionByName(back).distinct()


def local_joins(groups: DataFrame, dimension: int) -> DataFrame:
    """Pairs of members of the same ``center`` that beat the worst neighbour of one of them."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            own = batch.to_pandas()
            own = own if rest is None else pd.concat([rest, own], ignore_index=True)
            last = own["center"].to_numpy() == own["center"].iloc[-1]
            rest = own[last]
            yield from offers(own[~last])
        if rest is not None:
            yield from offers(rest)

    def offers(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        center = rows["center"].to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(center)) + 1, [len(center)]))
        size = np.diff(edges)
        vectors, member, worst = _rows(rows["small"], dimension), rows["member"].to_numpy(), rows["worst"].to_numpy()
        for i in range(0, len(size), 512):
            n, first = size[i:i + 512], edges[i:i + 512][:len(size[i:i + 512])]
            width = int(n.max())
            if width < 2:
                continue
            at = np.minimum(first[:, None] + np.arange(width), len(center) - 1)
            real = np.arange(width) < n[:, None]
            d = _squares(vectors[at])
            d[~(real[:, :, None] & real[:, None, :])] = np.inf
            d[:, np.arange(width), np.arange(width)] = np.inf
            k = min(OFFERS, width - 1)
            best = np.argpartition(d, k - 1, axis=2)[:, :, :k]
            value = np.take_along_axis(d, best, axis=2)
            good = value < worst[at][:, :, None]
            g, a, b = np.nonzero(good)
            yield pa.RecordBatch.from_arrays(
                [pa.array(member[at[g, a]]), pa.array(member[at[g, best[g, a, b]]]), pa.array(value[g, a, b].astype(np.float64))], names=["node", "near", "d"]
            )

    return groups.repartition("center").sortWithinPartitions("center").mapInArrow(join, "node long, near long, d double")


def descend(nodes: DataFrame, graph: DataFrame, dimension: int) -> DataFrame:
    """NN-descent: neighbours of neighbours are joined and measured until few lists still change."""
    total = graph.count()
    scratch = Scratch(nodes.sparkSession)
    while True:
        worst = graph.groupBy("node").agg(F.max("d").alias("far"), F.count("*").alias("n"))
        limit = F.when(F.col("n") >= DEGREE, F.col("far")).otherwise(F.lit(float("inf")))
        known = nodes.select("node", "small").join(worst, "node", "left").select(F.col("node").alias("member"), "small", F.coalesce(limit, F.lit(float("inf"))).alias("worst"))
        groups = _both_ways(graph).withColumnsRenamed({"node": "center", "near": "member"}).join(known, "member")
        offered = local_joins(groups.select("center", "member", "small", "worst"), dimension).where("node <> near")
        offered = offered.groupBy("node", "near").agg(F.min("d").alias("d")).join(graph.select("node", "near"), ["node", "near"], "left_anti")
        better = scratch.cut(nearest_rows(offered, "node", DEGREE), "llm-offers")
        changed = better.count()
        graph = scratch.cut(nearest_rows(graph.unionByName(better), "node", DEGREE), "llm-graph")
        scratch.drop_all_but(graph)
        if changed <= SETTLED * total:
            return graph


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, near, d``: for each of ``queries (query_id, own, vec)`` its nearest nodes found.

    A search starts from the query's own node (null if it is none) and a few fixed ones. In each
    step all nodes of its list that are new are opened and their neighbours measured.
    """
    ways = cut_lineage(_both_ways(graph), "llm-ways")
    entry = nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select(F.col("node").alias("near"))
    ask = queries.select("query_id", F.col("vec").alias("ask"))
    first = queries.where("own IS NOT NULL").select("query_id", F.col("own").alias("near")).unionByName(queries.select("query_id", F.explode(F.array(*[F.lit(r[0]) for r in entry.collect()] or [F.lit(None).cast("long")])).alias("near"))).distinct()

    def measured(pairs: DataFrame) -> DataFrame:
        named = pairs.join(nodes.select(F.col("node").alias("near"), "vec"), "near").join(ask, "query_id")
        return named.select("query_id", "near", distance("vec", "ask").alias("d"), F.lit(False).alias("opened"))

    order = Window.partitionBy("query_id").orderBy("d", "near")
    beam = cut_lineage(measured(first), "llm-beam")
    for _ in range(STEPS):
        fresh = beam.where("NOT opened").select("query_id", F.col("near").alias("node"))
        if fresh.isEmpty():
            break
        seen = beam.select("query_id", "near")
        pairs = fresh.join(ways, "node").select("query_id", "near").distinct().join(seen, ["query_id", "near"], "left_anti")
        more = beam.withColumn("opened", F.lit(True)).unionByName(measured(pairs))
        beam = cut_lineage(more.withColumn("place", F.row_number().over(order)).where(F.col("place") <= BEAM).drop("place"), "llm-beam")
    return beam.select("query_id", "near", "d")


def _packed(rows: DataFrame, idents: list[str], dimension: int, size: int, n: int, tag: str) -> DataFrame:
    """``no, body``: the columns ``idents`` and ``vec`` of ``n`` rows in blocks of at most ``size``, stored."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Arrays] = []
        count = 0

        def done() -> pa.RecordBatch:
            whole = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            return pa.RecordBatch.from_arrays([pa.array([pack(whole)], pa.binary())], names=["body"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                own = batch.slice(at, size)
                if held and count + own.num_rows > size:
                    yield done()
                    held, count = [], 0
                held.append({c: own.column(c).to_numpy(zero_copy_only=False) for c in idents} | {"x": matrix(own.column("vec"), dimension)})
                count += own.num_rows
        if held:
            yield done()

    with arrow_rows(rows.sparkSession, dimension):
        dealt = rows.select(*idents, "vec").repartition(max(1, -(-n // (2 * size))))
        packed = dealt.mapInArrow(gather, "body binary")
        return cut_lineage(packed.withColumn("no", F.monotonically_increasing_id()), tag)


def confirmed(nodes: DataFrame, found: DataFrame, queries: DataFrame, k: int, dimension: int, middle: np.ndarray) -> DataFrame:
    """``query_id, near, d``: the ``k`` nearest of all ``nodes (node, first, vec)`` to each query, among others.

    The search leaves each query the distance of its ``k``-th node, which few nodes undercut. Blocks of
    nodes pass the queries; a matrix product rules out what is farther, allowing for its rounding,
    and the rest is measured. Of a block the ``k`` nearest remain, ties by the node's least id.
    """
    order = Window.partitionBy("query_id").orderBy("d", "near")
    reach = found.withColumn("place", F.row_number().over(order)).where(F.col("place") == k).select("query_id", F.col("d").alias("reach"))
    asked = queries.join(reach, "query_id", "left").select("query_id", "vec", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    asked = cut_lineage(asked, "llm-asked")
    chunks = _packed(asked, ["query_id", "reach"], dimension, CHECK_QUERIES, asked.count(), "llm-check-queries")
    blocks = _packed(nodes, ["node", "first"], dimension, CHECK_NODES, nodes.count(), "llm-check-nodes")
    units = chunks.select(F.col("no").alias("chunk")).crossJoin(blocks.select(F.col("no").alias("block")))

    def prepare(own: Arrays) -> Arrays:
        y = own["x"] - middle
        return own | {"y": y, "n": (y * y).sum(axis=1)}

    def kernel(own: Arrays, chunk: Arrays) -> Arrays | None:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        z = chunk["x"] - middle
        m = (z * z).sum(axis=1)
        for i in range(0, len(z), CHECK_ROWS):
            some = slice(i, i + CHECK_ROWS)
            both = m[some, None] + own["n"]
            # what overflows is no number and is measured
            a, b = np.nonzero(~(both - 2 * z[some] @ own["y"].T > (chunk["reach"][some] ** 2)[:, None] + 1e-9 * both))
            a += i
            d = np.empty(len(a))
            for at in range(0, len(a), CHECK_PAIRS):
                x, y = chunk["x"][a[at:at + CHECK_PAIRS]], own["x"][b[at:at + CHECK_PAIRS]]
                total = np.zeros(len(x))
                for j in range(dimension):  # one after another, as the score adds them
                    total += (x[:, j] - y[:, j]) * (x[:, j] - y[:, j])
                d[at:at + CHECK_PAIRS] = np.sqrt(total)
            near = d <= chunk["reach"][a]
            a, b, d = a[near], b[near], d[near]
            by = np.lexsort((own["first"][b], d, a))
            a, b, d = a[by], b[by], d[by]
            kept = np.arange(len(a)) - np.searchsorted(a, a) < k
            out.append((chunk["query_id"][a[kept]], own["node"][b[kept]], d[kept]))
        query, node, d = (np.concatenate(x) for x in zip(*out))
        return {"query": query, "node": node, "d": d} if len(query) else None

    met = meet(chunks.withColumnRenamed("no", "chunk"), blocks, units, prepare, kernel)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                own = unpack(body.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(own[c]) for c in ("query", "node", "d")], names=["query_id", "near", "d"])

    with arrow_rows(nodes.sparkSession, CHECK_NODES * dimension):
        return cut_lineage(met.mapInArrow(rows, "query_id long, near long, d double"), "llm-confirmed")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each row where ``is_query`` holds.

    Euclidean distance in double precision on the given components; a query's own row is no
    candidate; ties go to the smaller ``vec_id``. Equal vectors are one node of the graph with
    its ``k + 1`` smallest ids, which are all that can be among the ``k`` nearest, so copies do
    not crowd lists. The graph is built on vectors less the median, in the precision of the
    input, and refined by NN-descent until it settles. What the search finds bounds the distance of
    the true neighbours; :func:`confirmed` looks for nearer ones among all vectors, so none is missed.

    Rows whose id or vector is null, zero or not finite, and vectors of a rarer dimension, take
    no part. A repeated id with another vector is a candidate of its own; with the same vector it
    counts once. An empty table gives no rows. Other columns are ignored.
    """
    rows = cut_lineage(usable(vectors).distinct(), "llm-vectors")
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    top = rows.agg(F.max(F.array_max(F.transform("vec", lambda x: F.abs(x)))), F.max(F.size("vec"))).first()
    if top[0] is None:
        return empty
    dimension = int(top[1])
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind, scale = (np.float32, 4.0) if single else (np.float64, float(top[0]))
    middle = middle_of(rows)

    def small(x: pd.Series) -> pd.Series:
        return x.map(lambda v: (np.asarray(v) / scale - middle / scale).astype(kind).tobytes())

    nodes = rows.select("vec").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = cut_lineage(nodes.withColumn("small", F.pandas_udf(small, "binary")("vec")), "llm-nodes")
    named = cut_lineage(rows.join(nodes.select("vec", "node"), "vec").select("vec_id", "node"), "llm-names")
    order = Window.partitionBy("node").orderBy("vec_id")
    members = named.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")
    graph = descend(nodes, start_graph(nodes, dimension, middle), dimension)
    asked = named.where(is_query).join(nodes.select("node", "vec"), "node").select(F.col("vec_id").alias("query_id"), F.col("node").alias("own"), "vec")
    asked = cut_lineage(asked.dropDuplicates(["query_id"]), "llm-queries")
    # with the own node, which may hold no other row, k + 1 nodes hold the k nearest rows
    first = nodes.select("node", "vec").join(named.groupBy("node").agg(F.min("vec_id").alias("first")), "node")
    found = confirmed(first, search(nodes, graph, asked), asked, k + 1, dimension, middle)
    found = found.join(members.withColumnRenamed("node", "near"), "near").where("vec_id <> query_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.min("d").alias("score")).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
