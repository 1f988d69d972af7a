"""Keys, row hashes and repeatable uniform numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from recordloom.settings import HASH_DIFF, KEY_SEPARATOR, LOAD_TS, UNKNOWN_PARTITION

# Field separator and null marker inside a hashed row.
FIELD_SEPARATOR = "\x1f"
NULL_MARKER = "\x00"


def composite_key(key_name: str | Column, value: Column) -> Column:
    """``<key name>-__-<value>``; null when the value is null."""
    name = F.lit(key_name) if isinstance(key_name, str) else key_name
    return F.concat(name, F.lit(KEY_SEPARATOR), value.cast("string"))


def digest(columns: Sequence[Column]) -> Column:
    """128-bit hex digest of a tuple of values, nulls told apart from empty strings."""
    marked = [F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in columns]
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *marked).cast("binary"))


def hash_diff(df: DataFrame, primary_key: Sequence[str]) -> Column:
    """Digest of every flat non-key column, in schema order."""
    skip = {*primary_key, HASH_DIFF, LOAD_TS}
    nested = (T.StructType, T.ArrayType, T.MapType)
    return digest([F.col(f.name) for f in df.schema if f.name not in skip and not isinstance(f.dataType, nested)])


def with_load_metadata(
    df: DataFrame, primary_key: Sequence[str], partition_key: str | None = None, load_ts: Column | None = None
) -> DataFrame:
    """Add the row hash and one load instant per batch; a null partition value gets its sentinel."""
    if partition_key:
        df = df.withColumn(partition_key, F.coalesce(F.col(partition_key), F.lit(UNKNOWN_PARTITION)))
    return df.withColumn(HASH_DIFF, hash_diff(df, primary_key)).withColumn(
        LOAD_TS, F.current_timestamp() if load_ts is None else load_ts
    )


def restore_unknown(df: DataFrame, partition_key: str | None) -> DataFrame:
    """Undo the partition sentinel on read."""
    if not partition_key:
        return df
    return df.withColumn(partition_key, F.nullif(F.col(partition_key), F.lit(UNKNOWN_PARTITION)))


def uniform(key: Column, salt: str = "") -> Column:
    """Uniform in (0, 1) derived from the key, equal in every run and every engine."""
    head = F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary")), 1, 8)
    return (F.conv(head, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
