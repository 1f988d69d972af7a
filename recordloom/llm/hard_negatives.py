"""Hard negatives for anchors: scores bounded by means and deviations of vector segments, refined, then exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordloom.llm.tables import Scratch
from recordloom.llm.vector_blocks import BLOCK, CHUNK, Arrays, aged, arrow_rows, blocks, extend, finite_vectors, least_kept, news, no_entries, pack, products, shape, unpack, waves

#: Segments of a vector, coarse first; each level bounds the pairs that the one before left.
SEGMENTS = (4, 16)
STEP = 512
SCALE = 256
_ENTRIES = ("row", "score", "near", "place")


def summaries(x: np.ndarray) -> Arrays:
    """``mean`` and ``dev`` of each segment at each level, both times the root of the segment's length.

    The product of two segments is that of their means plus that of what remains, and the latter
    is at most the product of the deviations.
    """
    out, d = {}, x.shape[1]
    for level in SEGMENTS:
        edges = np.unique(np.linspace(0, d, min(level, d) + 1).astype(int))
        length = np.diff(edges).astype(np.float64)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / length
        rest = x - np.repeat(mean, np.diff(edges), axis=1)
        out[f"mean{level}"] = mean * np.sqrt(length)
        out[f"dev{level}"] = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))
    return out


def _refine(block: Arrays, chunk: Arrays, rows: np.ndarray, cols: np.ndarray, mask: np.ndarray, least: np.ndarray, most: np.ndarray | None):
    """Rows, columns and mask of the pairs whose bounds still reach from ``least`` to ``most`` (both by row of the chunk)."""
    margin = 1e-9 * chunk["norm"] * (block["norm"][cols].max() if len(cols) else 0.0) + 1e-6
    for level in SEGMENTS:
        if not mask.size:
            break
        middle = chunk[f"mean{level}"][rows] @ block[f"mean{level}"][cols].T
        spread = chunk[f"dev{level}"][rows] @ block[f"dev{level}"][cols].T
        mask &= middle + spread >= (least - margin)[rows, None]
        if most is not None:
            mask &= middle - spread <= (most + margin)[rows, None]
        a, b = mask.any(axis=1), mask.any(axis=0)
        rows, cols, mask = rows[a], cols[b], mask[a][:, b]
    return rows, cols, mask


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, lowest_pct: int = 30, highest_pct: int = 90, scale: int = SCALE
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * c)`` and a score is the integer inner product with the anchor.
    The positives of a row where ``is_anchor`` holds are the ``positives`` highest scores among
    other rows of its ``label`` (an integer column); its negatives for a positive are the
    ``negatives`` highest among rows of another label whose score lies between ``lowest_pct`` and
    ``highest_pct`` percent of the positive's. Ties go to the smaller ``vec_id``. Each vector
    stores the mean and deviation of its segments; sums of products of means plus or minus
    products of deviations bound a score, level by level, and what can still matter is scored on
    the integers. The bounds allow for rounding, so the result is exact. A pair of anchor and
    positive without a negative in its range gives no rows; a negative positive score has none.

    Rows whose id, label or vector is null, or that hold null or non-finite components, and vectors
    of a rarer dimension or of none, take no part. No row with the anchor's id is its positive. A row
    repeated with the same integers and label counts once; an id with several vectors or labels is
    several rows, also as anchors. An empty table gives no rows. Other columns are ignored.
    Scores whose hundredfold may exceed 2^62 raise a ValueError.
    """
    scratch = Scratch(vectors.sparkSession)
    own = [F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("kind"), F.coalesce(is_anchor, F.lit(False)).alias("asks")]
    rows = finite_vectors(vectors.where(F.col("vec_id").isNotNull() & label.isNotNull()), lambda c: F.floor(c * scale), *own)
    rows = scratch.cut(rows.distinct(), "llm-labelled")
    dimension, top = shape(rows)
    if 100 * top * top * dimension >= 2.0**62:
        raise ValueError("inner products of these vectors do not fit a long")
    empty = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    names = empty.columns
    if not dimension:
        return empty
    exact = top * top * dimension < 2.0**53

    def positive_kernel(block: Arrays, chunk: Arrays) -> Arrays | None:
        kept, n = aged(chunk), len(chunk["x"])
        least = least_kept(kept, n, positives)
        for kind in np.intersect1d(chunk["kind"], block["kind"]):
            same = np.flatnonzero(block["kind"] == kind)
            for at in range(0, len(same), STEP):
                live = np.flatnonzero(chunk["kind"] == kind)
                cols = same[at:at + STEP]
                mask = chunk["vec_id"][live, None] != block["vec_id"][cols]
                live, cols, mask = _refine(block, chunk, live, cols, mask, least, None)
                if not mask.size:
                    continue
                score = products(chunk["x"][live], block["x"][cols], exact)
                a, b = np.nonzero(mask & (score >= least[live, None]))
                kept = extend(kept, {"row": live[a], "score": score[a, b], "near": block["vec_id"][cols[b]]}, positives)
                least = least_kept(kept, n, positives)
        return news(kept)

    def negative_kernel(block: Arrays, chunk: Arrays) -> Arrays | None:
        kept, n, slots = aged(chunk), len(chunk["x"]), len(chunk["of"])
        by_place = np.full((n, positives), -1)
        by_place[chunk["of"], chunk["at"]] = np.arange(slots)
        low = np.maximum(least_kept(kept, slots, negatives), chunk["low"])
        most = np.full(n, -np.inf)
        np.maximum.at(most, chunk["of"], chunk["high"])
        for at in range(0, len(block["x"]), STEP):
            cols, live = np.arange(at, min(at + STEP, len(block["x"]))), np.unique(chunk["of"])
            least = np.full(n, np.inf)
            np.minimum.at(least, chunk["of"], low)
            mask = (chunk["kind"][live, None] != block["kind"][cols]) & (least <= most)[live, None]
            live, cols, mask = _refine(block, chunk, live, cols, mask, least, most)
            if not mask.size:
                continue
            score = products(chunk["x"][live], block["x"][cols], exact)
            mask &= (score >= least[live, None]) & (score <= most[live, None])
            a, b = np.nonzero(mask)
            value, ident = score[a, b], block["vec_id"][cols[b]]
            found = []
            for place in range(positives):
                slot = by_place[live[a], place]
                fits = (slot >= 0) & (value >= low[slot]) & (value >= chunk["low"][slot]) & (value <= chunk["high"][slot])
                found.append((slot[fits], value[fits], ident[fits]))
            kept = extend(kept, dict(zip(("row", "score", "near"), map(np.concatenate, zip(*found)))), negatives)
            low = np.maximum(least_kept(kept, slots, negatives), chunk["low"])
        return news(kept)

    def need(chunk: Arrays) -> float:
        """Shortest length of a vector that can still be a negative for the chunk."""
        if not len(chunk["of"]):
            return np.inf
        low = np.maximum(least_kept(chunk, len(chunk["of"]), negatives), chunk["low"])
        fits = low <= chunk["high"]
        if not fits.any():
            return np.inf
        if (low[fits] <= 0).any():
            return -1.0
        return float((low[fits] * (1 - 1e-9) / chunk["norm"][chunk["of"][fits]]).min()) - 1e-6

    def asking(chunk: Arrays) -> Arrays:
        """A chunk whose lists are its positives, as one whose lists are their negatives."""
        score = chunk["score"]
        bounds = {"of": chunk["row"], "at": chunk["place"], "positive": chunk["near"], "value": score, "low": -((-lowest_pct * score) // 100), "high": (highest_pct * score) // 100}
        return {c: v for c, v in chunk.items() if c not in (*_ENTRIES, "fresh")} | bounds | no_entries()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, body in zip(batch.column("chunk"), batch.column("body")):
                ready = asking(unpack(body.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()]), pa.array([need(ready)]), pa.array([pack(ready)], pa.binary())], names=["chunk", "need", "body"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                c = unpack(body.as_py())
                slot = c["row"]
                cells = [c["vec_id"][c["of"][slot]], c["positive"][slot], (c["place"] + 1).astype(np.int32), c["near"], c["value"][slot], c["score"]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in cells], names=names)

    held, total = blocks(rows.drop("asks"), dimension, BLOCK, summaries, scratch, "llm-vectors")
    asked, _ = blocks(rows.where("asks").drop("asks"), dimension, CHUNK, lambda x: summaries(x) | no_entries(), scratch, "llm-anchors")
    state = asked.select(F.col("no").alias("chunk"), F.lit(-1.0).alias("need"), "body")
    merge_positives = lambda chunk, found: chunk | extend(aged(chunk), found, positives)
    merge_negatives = lambda chunk, found: chunk | extend(aged(chunk), found, negatives)
    state = waves(state, held, total, lambda block: block, positive_kernel, merge_positives, lambda chunk: -1.0, scratch, "llm-positives")
    with arrow_rows(rows.sparkSession, BLOCK * 64):
        state = scratch.cut(state.select("chunk", "body").mapInArrow(turn, "chunk long, need double, body binary"), "llm-pairs")
    state = waves(state, held, total, lambda block: block, negative_kernel, merge_negatives, need, scratch, "llm-negatives")
    with arrow_rows(rows.sparkSession, BLOCK * 64):
        out = scratch.cut(state.select("body").mapInArrow(lists, empty.schema), "llm-mined")
    scratch.drop_all_but(out)
    return out
