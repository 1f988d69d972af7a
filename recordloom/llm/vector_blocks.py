"""Integer vectors in stored blocks, and blocks of queries streamed against them.

A block is a row: its number, its longest vector and its arrays. A task holds one block of
vectors and meets some blocks of queries one after another, so its memory does not depend on
the size of the table, and a hot label or vector only fills more blocks.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordloom.llm.tables import Scratch

#: Vectors of a block, queries of a block of queries, and blocks of queries that one task meets at once.
BLOCK, CHUNK, TASK_CHUNKS = 2048, 256, 16
_ROWS, _CELLS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1 << 20

Arrays = dict[str, np.ndarray]


@contextmanager
def arrow_rows(spark: SparkSession, cells: int) -> Iterator[None]:
    """Arrow batches of about a million cells while a table of rows with ``cells`` cells each is written."""
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(max(1, min(int(before), _CELLS // max(cells, 1)))))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, before)


def finite_vectors(vectors: DataFrame, integer: Callable[[Column], Column], *others: Column) -> DataFrame:
    """``others`` and ``x`` (array of long, each component through ``integer``) of the rows whose
    ``embedding`` is neither null nor holds null or non-finite components.
    Of several dimensions the most common takes part, of equally common ones the smaller."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    vectors = vectors.where(fine)
    common = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    own = vectors.where(F.size("embedding") == (common[0] if common and common[0] else -2))
    return own.select(*others, F.transform("embedding", lambda c: integer(c.cast("double")).cast("long")).alias("x"))


def shape(rows: DataFrame) -> tuple[int, float]:
    """Dimension and largest absolute component; 0 and 0 of an empty table."""
    size = F.array_max(F.transform("x", lambda c: F.abs(c.cast("double"))))
    d, top = rows.agg(F.max(F.size("x")), F.max(size)).first()
    return int(d or 0), float(top or 0)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The rows of a list column; a sliced batch keeps only its own."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def pack(arrays: Arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(body: bytes) -> Arrays:
    with np.load(io.BytesIO(body)) as found:
        return {name: found[name] for name in found.files}


def blocks(rows: DataFrame, dimension: int, size: int, extra: Callable[[np.ndarray], Arrays], scratch: Scratch, tag: str) -> tuple[DataFrame, int]:
    """``no, top, body`` in descending order of length, and the number of blocks.

    ``rows`` have ``vec_id``, ``x`` and maybe more numeric columns; all go to the body, with the
    Euclidean length ``norm`` and what ``extra`` computes from the vectors. Equal lengths are
    spread by a digest of the id, so a vector that a third of the rows repeat fills many ranges.
    """
    others = [c for c in rows.columns if c != "x"]
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    order = [F.desc("#norm"), F.col("#mix"), F.col("vec_id")]
    placed = rows.withColumn("#norm", length).withColumn("#mix", F.xxhash64("vec_id", "x")).repartitionByRange(*order).sortWithinPartitions(*order)
    # the range and the place in it, in one number
    placed = scratch.cut(placed.select(F.monotonically_increasing_id().alias("#at"), *others, "x"), f"{tag}-placed")
    part = F.shiftright("#at", 33)
    # one row per range, of which there are as many as shuffle partitions
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for at, count in counts:
        starts.append((at, total))
        total += count
    first = rows.sparkSession.createDataFrame(starts, "`#part` long, `#first` long")
    rank = F.col("#first") + F.col("#at").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = placed.withColumn("#part", part).join(first, "#part").select(F.floor(rank / size).cast("long").alias("#no"), "#at", *others, "x")
    dealt = dealt.repartition("#no").sortWithinPartitions("#no", "#at").drop("#at")

    def finish(no: int, held: list[Arrays]) -> pa.RecordBatch:
        arrays = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        x = arrays["x"].astype(np.float64)
        arrays |= {"norm": np.sqrt((x * x).sum(axis=1))} | extra(x)
        cells = [pa.array([no]), pa.array([float(arrays["norm"].max())]), pa.array([pack(arrays)], pa.binary())]
        return pa.RecordBatch.from_arrays(cells, names=["no", "top", "body"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Arrays] = []
        at = -1
        for batch in batches:
            if not batch.num_rows:
                continue
            own = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in others} | {"x": matrix(batch.column("x"), dimension)}
            no = batch.column("#no").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(no)) + 1, [len(no)]))
            for a, b in zip(edges[:-1], edges[1:]):
                if no[a] != at and held:
                    yield finish(at, held)
                    held = []
                at = int(no[a])
                held.append({c: v[a:b] for c, v in own.items()})
        if held:
            yield finish(at, held)

    with arrow_rows(rows.sparkSession, dimension):
        stored = scratch.cut(dealt.mapInArrow(gather, "no long, top double, body binary"), tag)
    scratch.drop(placed)
    return stored, -(-total // size)


def best(row: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the ``k`` highest scores of each row stand, ties by smaller id, and their places from 0."""
    order = np.lexsort((ident, -score, row))
    sorted_rows = row[order]
    place = np.arange(len(row)) - np.searchsorted(sorted_rows, sorted_rows, side="left")
    return order[place < k], place[place < k]


def extend(kept: Arrays, found: Arrays, k: int) -> Arrays:
    """The lists ``row, score, near, place`` of ``kept`` after more entries; ``fresh`` marks the new ones."""
    both = {c: np.concatenate([kept[c], found[c]]) for c in ("row", "score", "near")}
    both["fresh"] = np.concatenate([kept["fresh"], np.ones(len(found["row"]), dtype=bool)])
    at, place = best(both["row"], both["score"], both["near"], k)
    return {c: v[at] for c, v in both.items()} | {"place": place}


def no_entries() -> Arrays:
    none = np.zeros(0, np.int64)
    return {"row": none, "score": none, "near": none, "place": none}


def aged(chunk: Arrays) -> Arrays:
    """The lists of a chunk, nothing of it fresh."""
    return {c: chunk[c] for c in ("row", "score", "near", "place")} | {"fresh": np.zeros(len(chunk["row"]), dtype=bool)}


def news(kept: Arrays) -> Arrays | None:
    new = kept["fresh"]
    return {c: kept[c][new] for c in ("row", "score", "near")} if new.any() else None


def least_kept(lists: Arrays, n: int, k: int) -> np.ndarray:
    """The ``k``-th score of each of ``n`` rows, minus infinity where there are fewer."""
    out = np.full(n, -np.inf)
    last = lists["place"] == k - 1
    out[lists["row"][last]] = lists["score"][last]
    return out


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; ``exact``: no sum reaches 2^53, so the floating product holds them."""
    if exact:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


Kernel = Callable[[Arrays, Arrays], Arrays | None]


def meet(state: DataFrame, vectors: DataFrame, units: DataFrame, prepare: Callable[[Arrays], Arrays], kernel: Kernel) -> DataFrame:
    """``chunk, body`` of what ``kernel`` finds for each of ``units (chunk, block)``.

    A block is sent once for ``TASK_CHUNKS`` neighbouring blocks of queries and comes before
    them, so the task keeps it and lets them pass.
    """
    units = units.withColumn("deal", F.floor(F.col("chunk") / TASK_CHUNKS))
    held = units.select("block", "deal").distinct().join(vectors.withColumnRenamed("no", "block"), "block").select("block", "deal", F.lit(-1).cast("long").alias("chunk"), "body")
    passing = units.join(state.select("chunk", "body"), "chunk").select("block", "deal", "chunk", "body")
    rows = held.unionByName(passing).repartition("block", "deal").sortWithinPartitions("block", "deal", "chunk").select("chunk", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Arrays = {}
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body")):
                if chunk < 0:
                    own = prepare(unpack(body.as_py()))
                elif (found := kernel(own, unpack(body.as_py()))) is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([pack(found)], pa.binary())], names=["chunk", "body"])

    return rows.mapInArrow(run, "chunk long, body binary")


def merged(state: DataFrame, found: DataFrame, merge: Callable[[Arrays, Arrays], Arrays], need: Callable[[Arrays], float]) -> DataFrame:
    """``chunk, need, body``: each state after all that was found for it."""
    rows = state.select("chunk", F.lit(0).alias("late"), "body").unionByName(found.select("chunk", F.lit(1).alias("late"), "body"))
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "late").select("chunk", "late", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([need(own)]), pa.array([pack(own)], pa.binary())], names=["chunk", "need", "body"])

        at, own = None, {}
        for batch in batches:
            for chunk, late, body in zip(batch.column("chunk").to_pylist(), batch.column("late").to_pylist(), batch.column("body")):
                arrays = unpack(body.as_py())
                if late:
                    own = merge(own, arrays)
                    continue
                if at is not None:
                    yield done()
                at, own = chunk, arrays
        if at is not None:
            yield done()

    return rows.mapInArrow(run, "chunk long, need double, body binary")


def waves(
    state: DataFrame, vectors: DataFrame, total: int, prepare: Callable[[Arrays], Arrays], kernel: Kernel, merge: Callable[[Arrays, Arrays], Arrays],
    need: Callable[[Arrays], float], scratch: Scratch, tag: str,
) -> DataFrame:
    """All ``state (chunk, need, body)`` after meeting the blocks of ``vectors``, longest first.

    Blocks come in waves of 1, 4, 16 and so on; what a wave finds raises the bounds of the next. A
    chunk meets the blocks whose longest vector is at least ``need``.
    """
    spark = state.sparkSession
    with arrow_rows(spark, BLOCK * 64):
        at, width = 0, 1
        while at < total:
            end = min(total, at + width)
            units = state.select("chunk", "need", F.explode(F.sequence(F.lit(at).cast("long"), F.lit(end - 1).cast("long"))).alias("block"))
            units = units.join(vectors.select(F.col("no").alias("block"), "top"), "block").where("top >= need").select("chunk", "block")
            found = scratch.cut(meet(state, vectors, units, prepare, kernel), f"{tag}-found")
            later = scratch.cut(merged(state, found, merge, need), f"{tag}-state")
            scratch.drop(found, state)
            state, at, width = later, end, width * 4
    return state
