"""Ranked deduplication: the best row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RANK = "_rank"


def fill_count(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Number of non-null top-level columns."""
    return sum((F.col(f"`{c}`").isNotNull().cast("int") for c in columns or df.columns), F.lit(0))


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key.

    ``row_number() = 1`` plans a group limit before the shuffle: every map task forwards
    one row per key, so a key that holds a third of the table costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).where(F.col(RANK) == 1).drop(RANK)


def tie_break(df: DataFrame) -> Column:
    """Last ordering key, a hash of the whole row: equal rows are interchangeable."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def dedup_ranked(df: DataFrame, keys: Sequence[str], ties: Sequence[Column] | None = None) -> DataFrame:
    """Source table: active rows first, then the score (or else the fuller row)."""
    order = [F.col("is_active").desc_nulls_last()] if "is_active" in df.columns else []
    if "global_score" in df.columns:
        order.append(F.col("global_score").desc_nulls_last())
    else:
        order.append(fill_count(df).desc())
    if not keys:
        raise ValueError("deduplication needs key columns")
    return first_per_key(df, keys, [*order, *(ties or [tie_break(df)])])


def dedup_integrated(
    df: DataFrame,
    keys: Sequence[str] = ("anchor_entity.entity_id", "anchor_entity.data_source"),
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """Integrated records: the same on a nested key; fails when nothing ranks the rows."""
    order = [F.col(c).desc_nulls_last() for c in ("is_active", "global_score") if c in df.columns]
    if not order:
        raise ValueError("neither is_active nor global_score is present to rank duplicates")
    return first_per_key(df, [F.col(k) for k in keys], [*order, *(ties or [tie_break(df)])])


def dedup_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after, one row."""
    tagged = before.select(F.lit(0).alias("stage")).unionAll(after.select(F.lit(1).alias("stage")))
    return tagged.agg(
        F.count_if(F.col("stage") == 0).alias("initial_count"),
        F.count_if(F.col("stage") == 1).alias("deduplicated_count"),
    )
