"""Session helpers: a local session for tests and the shared folder for durable cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "recordloom") -> SparkSession:
    """Session for tests and the bench. A cluster passes its own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def durable_dir(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder, because there every executor sees the same disk.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="recordloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cached frame the written table survives the loss of executors, and the
    plan that follows starts at a file scan instead of the whole history of ``df``.
    """
    spark = df.sparkSession
    path = f"{durable_dir(spark)}/recordloom/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
