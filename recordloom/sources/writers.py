"""Sinks: partitioned Parquet tables, JSON documents and quarantines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.settings import CLUSTER_ID


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_table(df: DataFrame, path: str, partition_key: str | None = None, mode: str = "append") -> None:
    """Append to (or create) a table partitioned by ``partition_key``.

    Rows are first brought together by partition value, so a write opens few files per
    value; the rebalance splits a value that holds much of the data over several files.
    """
    if partition_key is None:
        write_parquet(df, path, mode)
        return
    (
        df.hint("rebalance", F.col(partition_key))
        .write.mode(mode).option("compression", "snappy").partitionBy(partition_key).parquet(path)
    )


def overwrite_table(df: DataFrame, path: str, partition_key: str | None = None) -> None:
    """Replace all rows and the schema."""
    write_table(df, path, partition_key, mode="overwrite")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Small documents such as run metadata or model parameters."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def quarantine_rows(rejected: DataFrame, path: str, batch: str) -> None:
    """Rejected raw rows with their reasons, in a folder of their batch; a batch that runs again replaces its rows."""
    write_parquet(rejected, f"{path}/batch={batch}", mode="overwrite")


def quarantine_clusters(rejected: DataFrame, path: str) -> None:
    """Member rows of clusters that cannot be merged, one row per member.

    The rows stay flat and are stored sorted by cluster: a cluster may be of any size, so
    it is never packed into one value. The folder is that of a run, which replaces its own rows.
    """
    write_parquet(rejected.sortWithinPartitions(CLUSTER_ID), path, mode="overwrite")


def move_files(spark: SparkSession, paths: list[str], prefix: str, folder: str) -> None:
    """Move files below ``prefix`` to the same place below ``folder``; a file that is there already stays where it is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(prefix).getFileSystem(conf)
    root = fs.makeQualified(path(prefix)).toUri()
    for name in paths:
        own = fs.makeQualified(path(name))
        there = path(folder, root.relativize(own.toUri()).getPath())
        if not fs.exists(there):
            fs.mkdirs(there.getParent())
            if not fs.rename(own, there):
                raise OSError(f"{name!r} was not moved to {there.toString()!r}")
