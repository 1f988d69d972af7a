"""Reading tables, fold membership and stored intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordloom.session import durable_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only the id and the text, so other columns of any name do not matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_fold(doc_id: str, folds: int) -> Column:
    """Remainder of the id's CRC-32; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def cut_lineage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; see :class:`Scratch`."""
    return Scratch(df.sparkSession).cut(df, tag)


class Scratch:
    """Tables in the shared folder that an operator stores and removes again.

    While a table is written, Spark is asked to remove the shuffle files of that query at its
    end: nothing reads them once the table is there. :meth:`drop` removes tables whose readers
    have themselves been stored, so that an operator of many steps holds the disk of one step.
    With ``batch_bytes`` the rows go to Python in Arrow batches of about that size.
    """

    def __init__(self, spark: SparkSession, batch_bytes: int | None = None) -> None:
        self.spark = spark
        self.confs = {_CLEANUP: "true"} | ({} if batch_bytes is None else {_BATCH_BYTES: str(batch_bytes)})
        self.tables: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame, tag: str) -> DataFrame:
        path = f"{durable_dir(self.spark)}/recordloom/{tag}-{uuid.uuid4().hex}"
        before = {name: self.spark.conf.get(name, None) for name in self.confs}
        for name, value in self.confs.items():
            self.spark.conf.set(name, value)
        try:
            df.write.parquet(path)
        finally:
            for name, value in before.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Remove the tables behind ``frames``; frames that this object did not store are passed over."""
        gone = [path for df, path in self.tables if any(df is f for f in frames)]
        self.tables = [(df, path) for df, path in self.tables if path not in gone]
        for path in gone:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def drop_all_but(self, *frames: DataFrame | None) -> None:
        """Remove every table stored so far but those behind ``frames``."""
        self.drop(*[df for df, _ in self.tables if not any(df is f for f in frames)])
