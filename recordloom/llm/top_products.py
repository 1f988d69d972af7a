"""Exact top-k by inner product: vectors in descending length, pruned by Cauchy-Schwarz bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordloom.llm.tables import Scratch
from recordloom.llm.vector_blocks import BLOCK, CHUNK, Arrays, aged, arrow_rows, blocks, extend, finite_vectors, least_kept, matrix, news, no_entries, products, shape, unpack, waves

#: Vectors of a block that are scored before the bounds are raised.
STEP = 512
#: Shares of the rotated components after which the rest is bounded by its length.
PARTS = (0.25, 0.5)
SCALE = 64


def gram(rows: DataFrame, dimension: int) -> np.ndarray:
    """Sum of the outer products of all ``x``; tasks send one sum per pair of components."""
    first, second = np.triu_indices(dimension)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            x = matrix(batch.column("x"), dimension).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), pa.array(total[first, second])], names=["i", "j", "v"])

    found = rows.select("x").mapInArrow(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((dimension, dimension))
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    out[i, j] = out[j, i] = found.column("v").to_numpy()
    return out


def rotation(rows: DataFrame, dimension: int) -> np.ndarray:
    """Right singular vectors of the table of vectors, the strongest first."""
    _, turned = np.linalg.eigh(gram(rows, dimension))
    return np.ascontiguousarray(turned[:, ::-1])


def slack(length: np.ndarray | float) -> np.ndarray | float:
    """More than the rounding of a sum of products of at most this size."""
    return 1e-9 * length + 1e-6


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest integer inner product of each row where ``is_query`` holds.

    Components become ``floor(scale * c)``. Blocks of vectors come in descending length; a block
    matters to a query while the product of the lengths reaches its ``k``-th score. Inside a
    block the products are summed over the first components of an SVD rotation and the rest is
    bounded by the lengths of both remainders; what is left is scored on the integers. The bounds
    allow for rounding, so the result is exact, with ties to the smaller ``vec_id``.

    The own row of a query is no candidate, nor is any of its id. Rows whose id or vector is null,
    or that hold null or non-finite components, and vectors of a rarer dimension or of none, take no
    part. A row repeated with the same integers counts once; an id with several vectors is several
    candidates, and several queries of one id. An empty table gives no rows. Other columns are
    ignored. Scores above 2^62 raise a ValueError, as they may not fit.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = finite_vectors(vectors.where("vec_id IS NOT NULL"), lambda c: F.floor(c * scale), F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = scratch.cut(rows.distinct(), "llm-products")
    dimension, top = shape(rows)
    if top * top * dimension >= 2.0**62:
        raise ValueError("inner products of these vectors do not fit a long")
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not dimension:
        return empty
    exact = top * top * dimension < 2.0**53
    turn = rotation(rows, dimension)
    steps = [p for p in sorted({int(dimension * s) for s in PARTS}) if 0 < p < dimension]

    def turned(arrays: Arrays) -> Arrays:
        r = arrays["x"].astype(np.float64) @ turn
        return {"r": r} | {f"rest{p}": np.sqrt((r[:, p:] ** 2).sum(axis=1)) for p in steps}

    def prepare(block: Arrays) -> Arrays:
        return block | turned(block)

    def kernel(block: Arrays, chunk: Arrays) -> Arrays | None:
        own, n = turned(chunk), len(chunk["x"])
        kept = aged(chunk)
        least = least_kept(kept, n, k)
        for at in range(0, len(block["x"]), STEP):
            cols = np.arange(at, min(at + STEP, len(block["x"])))
            longest = chunk["norm"] * block["norm"][cols].max()
            margin = slack(longest)
            live = np.flatnonzero(longest + margin >= least)
            if not len(live):
                break
            mask = np.ones((len(live), len(cols)), dtype=bool)
            for p in steps:
                bound = own["r"][live, :p] @ block["r"][cols, :p].T
                bound += own[f"rest{p}"][live, None] * block[f"rest{p}"][cols]
                mask &= bound >= (least - margin)[live, None]
                a, b = mask.any(axis=1), mask.any(axis=0)
                live, cols, mask = live[a], cols[b], mask[a][:, b]
            if not mask.size:
                continue
            score = products(chunk["x"][live], block["x"][cols], exact)
            mask &= (score >= least[live, None]) & (chunk["vec_id"][live, None] != block["vec_id"][cols])
            a, b = np.nonzero(mask)
            if not len(a):
                continue
            kept = extend(kept, {"row": live[a], "score": score[a, b], "near": block["vec_id"][cols[b]]}, k)
            least = least_kept(kept, n, k)
        return news(kept)

    def merge(chunk: Arrays, found: Arrays) -> Arrays:
        return chunk | extend(aged(chunk), found, k)

    def need(chunk: Arrays) -> float:
        """Shortest length of a vector that can still enter a list of the chunk."""
        least = least_kept(chunk, len(chunk["x"]), k)
        if (least <= 0).any():
            return -1.0
        return float((least * (1 - 1e-9) / chunk["norm"]).min()) - 1e-6

    held, total = blocks(rows.select("vec_id", "x"), dimension, BLOCK, lambda x: {}, scratch, "llm-vectors")
    asked, _ = blocks(rows.where("asks").select("vec_id", "x"), dimension, CHUNK, lambda x: no_entries(), scratch, "llm-asked")
    state = asked.select(F.col("no").alias("chunk"), F.lit(-1.0).alias("need"), "body")
    state = waves(state, held, total, prepare, kernel, merge, need, scratch, "llm-products")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                c = unpack(body.as_py())
                cells = [pa.array(c["vec_id"][c["row"]]), pa.array((c["place"] + 1).astype(np.int32)), pa.array(c["near"]), pa.array(c["score"])]
                yield pa.RecordBatch.from_arrays(cells, names=["query_id", "rank", "vec_id", "score"])

    with arrow_rows(rows.sparkSession, BLOCK * 64):
        out = scratch.cut(state.select("body").mapInArrow(lists, empty.schema), "llm-ranked")
    scratch.drop_all_but(out)
    return out
