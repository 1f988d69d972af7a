"""Weighted reservoir sampling (A-Res, Efraimidis and Spirakis 2006) and its accounting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.keys import uniform
from recordloom.settings import SAMPLE_ROWS

SCORE = "sample_score"
MAX_WEIGHT = 100.0


def check_weights(weights: Mapping[str, float], most: float | None = MAX_WEIGHT) -> dict[str, float]:
    """A negative weight is an error. ``most`` caps large ones; sampling itself uses them as they are."""
    negative = {k: w for k, w in weights.items() if w < 0}
    if negative:
        raise ValueError(f"negative sample weights: {negative}")
    return {k: float(w) if most is None else min(float(w), most) for k, w in weights.items()}


def weight_of(value: Column, weights: Mapping[str, float], default: float = 1.0) -> Column:
    """Weight of a value; unmapped values get the default."""
    pairs = check_weights(weights, most=None)
    if default < 0:
        raise ValueError("negative default weight")
    lookup = F.create_map(*[F.lit(x) for p in pairs.items() for x in p]) if pairs else None
    found = F.try_element_at(lookup, value.cast("string")) if pairs else F.lit(None)
    return F.coalesce(found, F.lit(float(default)))


def sample_scores(
    df: DataFrame,
    weight_column: str,
    weights: Mapping[str, float] | None = None,
    default_weight: float = 1.0,
    key: Column | None = None,
    salt: str = "",
) -> DataFrame:
    """Score ``U^(1/w)`` per row with positive weight. ``U`` comes from the key when one is
    given, so the same rows are drawn again after a lost executor; else it is random."""
    w = weight_of(F.col(weight_column), weights or {}, default_weight)
    u = F.rand() if key is None else uniform(key, salt)
    return df.withColumn("_w", w).where(F.col("_w") > 0).withColumn(SCORE, F.pow(u, F.lit(1.0) / F.col("_w"))).drop("_w")


def top_scores(scored: DataFrame, rows: int = SAMPLE_ROWS, tie: Column | None = None) -> DataFrame:
    """The ``rows`` highest scores. Mergeable: a top-k of top-k's is the top-k of their union."""
    order = [F.col(SCORE).desc(), *([tie] if tie is not None else [])]
    return scored.orderBy(*order).limit(rows)


def weighted_sample(
    df: DataFrame,
    weight_column: str,
    weights: Mapping[str, float] | None = None,
    rows: int = SAMPLE_ROWS,
    default_weight: float = 1.0,
    key: Column | None = None,
    salt: str = "",
) -> DataFrame:
    """Weighted sample without replacement: every partition keeps its own best ``rows`` and
    only those are merged."""
    return top_scores(sample_scores(df, weight_column, weights, default_weight, key, salt), rows, key)


def raw_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value over the whole table."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), "value"
    )


def sample_distribution(sample: DataFrame, column: str) -> DataFrame:
    """Rows per value inside the sample; null shows as ``None``."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value")
    return sample.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "value")


def sample_accounting(df: DataFrame, sample: DataFrame, weight_column: str, weights=None, default_weight=1.0) -> DataFrame:
    """Sampled rows and the raw rows that had a positive weight."""
    w = weight_of(F.col(weight_column), weights or {}, default_weight)
    both = df.where(w > 0).select(F.lit(0).alias("s")).unionAll(sample.select(F.lit(1).alias("s")))
    return both.agg(
        F.count_if(F.col("s") == 1).alias("sampled_rows"), F.count_if(F.col("s") == 0).alias("raw_rows")
    )
