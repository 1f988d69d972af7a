"""Incremental ingest and a running sample over file streams."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from recordloom.operators.sampling import sample_scores, top_scores
from recordloom.operators.validate import validate
from recordloom.plans.jobs import Layout, load_validated
from recordloom.settings import SAMPLE_ROWS
from recordloom.sources.readers import CORRUPT, with_corrupt
from recordloom.specs import SourceSpec


def raw_stream(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, archive: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """File stream with a declared schema. With ``archive`` a finished file is moved there when
    the next batch or run starts; what was loaded is decided by the checkpoint alone."""
    reader = spark.readStream.format(fmt).schema(with_corrupt(schema) if fmt == "csv" else schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def run_available(stream: DataFrame, each_batch, checkpoint: str) -> None:
    """Process everything that has arrived, then stop."""
    query = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_bronze(
    spark: SparkSession, path: str, spec: SourceSpec, layout: Layout, checkpoint: str, archive: str | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Validate and upsert new raw files, each batch once.

    A batch is named by its checkpoint and number. The table notes the name with the version and
    the quarantine keeps a folder per name, so a replay leaves table, version and quarantine as they are.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def load(batch: DataFrame, number: int) -> None:
        load_validated(batch.sparkSession, validate(batch, spec).stored(), layout, f"{stream}-{number}")

    run_available(raw_stream(spark, path, "csv", spec.raw_schema, archive, files_per_batch), load, checkpoint)


class RunningSample:
    """Weighted top-k sample kept over a stream. Scores come from the row key, so merging the
    previous top-k with a batch gives the sample of everything seen, in whatever batches."""

    def __init__(
        self, path: str, weight_column: str, key: str, weights: Mapping[str, float] | None = None,
        rows: int = SAMPLE_ROWS, default_weight: float = 1.0,
    ):
        self.path, self.weight_column, self.key = path.rstrip("/"), weight_column, key
        self.weights, self.rows, self.default_weight = weights, rows, default_weight

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """State of batch n is written to its own folder from the state of batch n-1, so a
        replayed batch rewrites the same folder with the same rows."""
        scored = top_scores(
            sample_scores(batch, self.weight_column, self.weights, self.default_weight, F.col(self.key)),
            self.rows, F.col(self.key),
        )
        if batch_id > 0:
            previous = batch.sparkSession.read.schema(scored.schema).parquet(f"{self.path}/batch={batch_id - 1}")
            scored = top_scores(previous.unionByName(scored).dropDuplicates([self.key]), self.rows, F.col(self.key))
        scored.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def result(self, spark: SparkSession) -> DataFrame:
        states = spark.read.parquet(self.path)
        last = states.agg(F.max("batch").alias("b")).first()["b"]
        return spark.read.parquet(f"{self.path}/batch={last}")
