"""Bring sources with different columns under one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from recordloom.functions.keys import composite_key
from recordloom.settings import COMPOSITE_ID, DATA_SOURCE, HASH_DIFF, UNIQUE_ID


def master_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Union of all fields, the first type of a name wins, plus unique_id and data_source."""
    fields: dict[str, T.StructField] = {}
    for f in (f for schema in schemas for f in schema):
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    for name in (UNIQUE_ID, DATA_SOURCE):
        fields[name] = T.StructField(name, T.StringType(), True)
    return T.StructType(list(fields.values()))


def align_to(df: DataFrame, schema: T.StructType, primary_key: str, source: str) -> DataFrame:
    """Cast to the master schema; a missing column becomes a typed null."""
    tagged = df.withColumn(UNIQUE_ID, F.col(primary_key).cast("string")).withColumn(DATA_SOURCE, F.lit(source))
    return tagged.select(
        *[
            (F.col(f.name) if f.name in tagged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def tag_source(df: DataFrame, primary_key: str, source: str) -> DataFrame:
    """Composite id and source name; the row hash is of no use after integration."""
    return (
        df.withColumn(COMPOSITE_ID, composite_key(primary_key, F.col(primary_key)))
        .withColumn(DATA_SOURCE, F.lit(source))
        .drop(HASH_DIFF)
    )


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of every frame; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_sources(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``{source: (frame, primary key)}`` as one table under the master schema."""
    schema = master_schema([df.schema for df, _ in frames.values()])
    return union_by_name([align_to(df, schema, key, name) for name, (df, key) in frames.items()])
