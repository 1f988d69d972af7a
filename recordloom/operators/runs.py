"""Run metadata."""

from __future__ import annotations

import json
import platform
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.operators.resolution import linkage_summary, overlap_report, record_counts
from recordloom.settings import DATA_SOURCE


def table_group(tables: Column) -> Column:
    """Name of a group of inputs, whatever their order."""
    return F.array_join(F.array_sort(tables), ",")


def latest_runs(runs: DataFrame, tables: str = "table_names", timestamp: str = "timestamp", tie: str = "run_id") -> DataFrame:
    """Newest run per group of input tables; the smallest run id on a tie."""
    newest = F.max_by(F.struct("*"), F.struct(F.col(timestamp)))
    if tie in runs.columns:
        newest = F.min_by(F.struct("*"), F.struct((-F.unix_micros(timestamp)).alias("t"), F.col(tie).alias("k")))
    return runs.groupBy(table_group(F.col(tables)).alias("table_group")).agg(newest.alias("run")).select(
        "table_group", "run.*"
    )


def settings_hash(settings: Mapping) -> Column:
    return F.md5(F.lit(json.dumps(settings, sort_keys=True)).cast("binary"))


def run_record(
    link_rows: DataFrame, tables: Sequence[str], settings: Mapping, links_path: str | None = None, run_id: str | None = None
) -> DataFrame:
    """One row that documents a resolution run. The maps hold one entry per source combination."""
    spark = link_rows.sparkSession
    per_source = record_counts(link_rows).where(F.col(DATA_SOURCE).isNotNull())
    as_map = F.map_from_entries(F.array_sort(F.collect_list(F.struct(DATA_SOURCE, "n_records"))))
    overlap = overlap_report(link_rows).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("sources", "n_clusters")))).alias("m")
    )
    return linkage_summary(link_rows).select(
        F.lit(run_id or time_ordered_id()).alias("run_id"),
        F.lit(links_path).alias("links_path"),
        F.current_timestamp().alias("timestamp"),
        F.lit(platform.python_version()).alias("python_version"),
        F.lit(spark.version).alias("spark_version"),
        F.array(*[F.lit(t) for t in tables]).alias("table_names"),
        per_source.agg(as_map.alias("m")).scalar().alias("per_source_records_count"),
        F.col("links_count").alias("records_count"),
        "links_count", "clusters_count", "linkage_rate",
        settings_hash(settings).alias("settings_hash"),
        F.lit(json.dumps(settings, sort_keys=True)).alias("settings"),
        overlap.scalar().alias("overlap_report"),
    )


def time_ordered_id() -> str:
    """Random id whose text order follows creation time."""
    import time

    millis = int(time.time() * 1000)
    value = (millis << 80) | (uuid.uuid4().int & ((1 << 80) - 1))
    value = (value & ~(0xF << 76)) | (0x7 << 76)
    value = (value & ~(0x3 << 62)) | (0x2 << 62)
    return str(uuid.UUID(int=value))
