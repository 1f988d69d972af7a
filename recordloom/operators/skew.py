"""Joins against one row per key that stay even when a key holds a third of the rows, or most keys are null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 50_000  # rows of a key that one task handles without being split
HOT_KEYS = 1_000  # a key is split from this part of all rows on, so no more keys than this are
NULL_SLICES = 1_024
_SLICES, _SLICE = "_slices", "_slice"


def heavy_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key, _slices``: the keys of ``counts (key, n)`` to be split, and in how many parts.

    A key is heavy from ``hot_rows`` rows on, but at least a thousandth of all rows, so the result
    has at most ``HOT_KEYS`` rows at any size.
    """
    limit = F.greatest(F.lit(float(hot_rows)), counts.agg(F.coalesce(F.sum(n), F.lit(0))).scalar() / F.lit(float(HOT_KEYS)))
    heavy = counts.where(F.col(key).isNotNull() & (F.col(n) >= limit))
    return heavy.select(key, F.ceil(F.col(n) / limit).cast("int").alias(_SLICES))


def split_join(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame, spread: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per ``key``; ``how`` is inner or left.

    The rows of a heavy key are dealt to its slices by a hash of the columns ``spread``, which tell
    rows of a key apart, and its row of ``right`` is copied to each slice. Rows with a null key
    match nothing and are dealt likewise. The hash depends on the row alone, so a task that runs
    again deals its rows alike. ``heavy``, from :func:`heavy_keys`, is bounded and broadcast.
    """
    heavy = F.broadcast(heavy)
    dealt = F.xxhash64(*spread)
    place = F.when(F.col(key).isNull(), -1 - F.pmod(dealt, F.lit(NULL_SLICES))).otherwise(F.coalesce(F.pmod(dealt, F.col(_SLICES)), F.lit(0)))
    rows = left.join(heavy, key, "left").withColumn(_SLICE, place.cast("int")).drop(_SLICES)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1))
    ones = right.join(heavy, key, "left").withColumn(_SLICE, copies).drop(_SLICES)
    return rows.join(ones, [key, _SLICE], how).drop(_SLICE)
