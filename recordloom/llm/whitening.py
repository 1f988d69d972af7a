"""Whitening components by shifted CholeskyQR on distributed Gram sums, then an SVD of the small factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordloom.llm.tables import Scratch
from recordloom.llm.vector_blocks import arrow_rows, finite_vectors, matrix, shape

SCALE, OFFSET = 1024, 100_000
#: Largest deviation of the orthogonalised rows' Gram matrix from the identity, times the dimension.
ORTHOGONAL = 1e-13
#: Directions whose squared length the first pass left below this hold nothing but rounding.
NOTHING = 1e-13
_PASSES = 8


@dataclass
class Factors:
    """Rows ``x`` become ``(n * x - sums) / n`` and then pass through ``steps``.

    A step is an upper triangular factor, whose inverse is applied by a triangular solve, or a
    matrix of orthonormal columns that span what is left of a deficient table.
    """

    n: int
    sums: np.ndarray
    steps: list[tuple[str, np.ndarray]] = field(default_factory=list)

    def whole(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, in integers."""
        return np.int64(self.n) * x - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        q = self.whole(x) / float(self.n)
        for kind, r in self.steps:
            q = solved(q, r) if kind == "solve" else q @ r
        return q

    def composed(self, dimension: int) -> np.ndarray:
        """The factor ``R`` with ``centred rows = orthogonal rows @ R``."""
        out = np.eye(dimension)
        for kind, r in self.steps:
            out = r @ out if kind == "solve" else r.T @ out
        return out


def solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``y @ inverse(r)`` of an upper triangular ``r``, column by column."""
    q = np.empty_like(y)
    for j in range(r.shape[1]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def summed(rows: DataFrame, dimension: int, value: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of the matrices that ``value`` gives for slices of them; tasks send one each, cell by cell."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = value(matrix(batch.column("x"), dimension))
                total = own if total is None else total + own
        if total is not None:
            i, j = (c.ravel().astype(np.int32) for c in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    with arrow_rows(rows.sparkSession, dimension):
        found = rows.select("x").mapInArrow(sums, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    out = np.zeros((i.max() + 1, j.max() + 1), dtype=np.int64 if kind == "long" else np.float64)
    out[i, j] = found.column("v").to_numpy()
    return out


def gram(rows: DataFrame, dimension: int, factors: Factors, turn: Callable[[np.ndarray], np.ndarray] = lambda q: q) -> np.ndarray:
    def products(x: np.ndarray) -> np.ndarray:
        q = turn(factors.rows(x))
        return q.T @ q

    found = summed(rows, dimension, products, "double")
    return (found + found.T) / 2


def orthogonalise(rows: DataFrame, dimension: int, factors: Factors) -> float:
    """Add steps to ``factors`` until the rows they give are orthonormal; returns the centred rows' squared size.

    The first Gram matrix is shifted, so that it has a Cholesky factor however badly the
    components are scaled against each other; the passes after it repair what the shift left.
    Directions without any spread come out of the first pass at the size of rounding and are cut.
    """
    size = 0.0
    for done in range(_PASSES):
        g = gram(rows, dimension, factors)
        if done == 0:
            size = float(np.trace(g))
            if size <= 0:
                return 0.0
            shift = 11 * (dimension * factors.n + dimension * (dimension + 1)) * np.finfo(float).eps / 2 * size
            g = g + min(shift, 1e-9 * size) * np.eye(dimension)
        elif np.abs(g - np.eye(len(g))).max() * len(g) <= ORTHOGONAL * dimension:
            return size
        else:
            values, turned = np.linalg.eigh(g)
            if values[0] <= NOTHING:
                factors.steps.append(("turn", np.ascontiguousarray(turned[:, values > NOTHING])))
                continue
        factors.steps.append(("solve", np.linalg.cholesky(g).T))
    return size


def whiten(vectors: DataFrame, components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    Components of vectors become ``x = floor(scale * c) + offset``. ``n`` and the sums ``S`` are
    taken in integers, so rows are centred without cancellation. Gram passes over the table
    orthogonalise the centred rows by triangular solves; the factors compose to a small ``R``
    whose SVD gives the unit eigenvectors of the covariance (divisor ``n``) and its eigenvalues,
    numbered from 1 by falling eigenvalue. ``whitened`` is the row's projection over the root of the
    eigenvalue, ``deviation`` the exact sum of ``(n * x - S)^2``, ``explained`` the eigenvalue's share
    of the trace, ``identity_error`` the largest entry of the whitened rows' covariance less the
    identity, measured in two more passes.

    Rows whose vector is null or holds null or non-finite components, and vectors of a rarer
    dimension or of none, take no part. A null id stays null; repeated rows count each. Directions
    without spread have no component, so a table of equal vectors, of one row or of none gives no
    rows. A ``deviation`` that does not fit a long is null. Other columns are ignored. Components
    so large that their sum may not fit a long raise a ValueError.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = finite_vectors(vectors, lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(1 << 62)), F.lit(-(1 << 62))) + F.lit(offset), F.col("vec_id").cast("long").alias("vec_id"))
    rows = scratch.cut(rows, "llm-entries")
    dimension, top = shape(rows)
    n = rows.count()
    if top * n >= 2.0**62:
        raise ValueError("sums of these vectors do not fit a long")
    names = empty.columns
    if not n:
        return empty
    factors = Factors(n, summed(rows, dimension, lambda x: x.sum(axis=0)[None], "long")[0])
    size = orthogonalise(rows, dimension, factors)
    if size <= 0:
        scratch.drop(rows)
        return empty
    _, stretch, turned = np.linalg.svd(factors.composed(dimension))
    kept = min(components, len(stretch))
    # the rows of ``turned`` are the eigenvectors; eigenvalue = stretch^2 / n
    project = turned[:kept].T / stretch[:kept] * np.sqrt(n)
    explained = stretch[:kept] ** 2 / size
    centred = Factors(n, factors.sums)
    mean = summed(rows, dimension, lambda x: (centred.rows(x) @ project).sum(axis=0)[None], "double")[0] / n
    error = float(np.abs(gram(rows, dimension, centred, lambda q: q @ project - mean) / n - np.eye(kept)).max())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = matrix(batch.column("x"), dimension)
            whole = centred.whole(x)
            about = (whole.astype(np.float64) ** 2).sum(axis=1)
            # integer sums wrap at 2^64, so they are right wherever the true sum fits
            deviation = pa.array((whole * whole).sum(axis=1), mask=about >= 2.0**63 * (1 - 1e-9))
            at = np.repeat(np.arange(m), kept)
            cells = [batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)), pa.array(np.full(m * kept, n)), deviation.take(pa.array(at)),
                     pa.array((centred.rows(x) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * kept, error))]
            yield pa.RecordBatch.from_arrays(cells, names=names)

    with arrow_rows(spark, dimension + 7 * kept):
        out = scratch.cut(rows.mapInArrow(finish, empty.schema), "llm-whitened")
    scratch.drop_all_but(out)
    return out
