"""File streams over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions.text import canonical
from recordloom.plans import jobs
from recordloom.plans.jobs import Layout, silver_table
from recordloom.sources.readers import discover
from recordloom.specs import Reject, SourceSpec
from recordloom.streaming.ingest import RunningSample, ingest_bronze, raw_stream, run_available
from recordloom.suite.auditing import WEIGHTS, _SAMPLE_SQL
from recordloom.suite.base import query, scratch, table

EVENT_SPEC = SourceSpec(
    name="event_feed",
    path_pattern="event",
    primary_key=("event_id",),
    schema=T.StructType(
        [
            T.StructField("event_id", T.LongType(), False), T.StructField("user_id", T.LongType(), False),
            T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
        ]
    ),
    columns={
        "event_id": lambda: F.col("event_id").cast("bigint"),
        "user_id": lambda: F.when(F.col("event_type") != "error", F.col("user_id").cast("bigint")),
        "event_type": lambda: canonical(F.col("event_type")),
        "value": lambda: F.col("value").cast("double"),
    },
    raw_header=("event_id", "user_id", "event_type", "value"),
    rejects=(Reject("value_negative", lambda: F.col("value") < 0),),
)


def _event_files(spark, sf_dir, fmt="parquet"):
    """The event table as a folder of several files, so that a stream takes several batches."""
    path = scratch(spark, "event-files")
    events = table(spark, sf_dir, "events")
    events = events if fmt == "parquet" else events.select(*EVENT_SPEC.raw_header)
    events.repartition(4, "event_id").write.option("header", True).format(fmt).save(path)
    return path


def _ingested(spark, sf_dir):
    """Raw files through the ingest job, in batches of two files, and all of them once more from
    the start, as after the loss of the stream's progress."""
    files, layout = _event_files(spark, sf_dir, "csv"), Layout(scratch(spark, "event-lake"))
    for _ in range(2):
        ingest_bronze(spark, files, EVENT_SPEC, layout, scratch(spark, "checkpoint"), files_per_batch=2)
    return layout


@query(
    "incremental_ingest",
    """SELECT event_id, user_id, upper(event_type) AS event_type, value FROM events
       WHERE event_type <> 'error' AND user_id IS NOT NULL AND NOT coalesce(value < 0, false)""",
)
def incremental_ingest(spark, sf_dir):
    """New files are validated and upserted batch by batch into a history table."""
    layout = Layout(scratch(spark, "event-lake"))
    ingest_bronze(spark, _event_files(spark, sf_dir, "csv"), EVENT_SPEC, layout, scratch(spark, "checkpoint"), files_per_batch=2)
    return silver_table(spark, layout, EVENT_SPEC).read().select("event_id", "user_id", "event_type", "value")


@query(
    "load_new_files",
    """SELECT event_id, user_id, upper(event_type) AS event_type, value, 1 AS loads, 0 AS files_left FROM events
       WHERE event_type <> 'error' AND user_id IS NOT NULL AND NOT coalesce(value < 0, false)""",
)
def load_new_files(spark, sf_dir):
    """A folder loaded by its manifest: the second call finds nothing new, and what is loaded is archived."""
    files, layout, archive = _event_files(spark, sf_dir, "csv"), Layout(scratch(spark, "event-lake")), scratch(spark, "archive")
    loads = [n for _ in range(2) for n in jobs.load_new_files(spark, files, [EVENT_SPEC], layout, archive)]
    rows = silver_table(spark, layout, EVENT_SPEC).read().select("event_id", "user_id", "event_type", "value")
    return rows.select("*", F.lit(len(loads)).alias("loads"), F.lit(discover(spark, files).count()).cast("int").alias("files_left"))


@query(
    "ingest_twice",
    """SELECT event_id, user_id, upper(event_type) AS event_type, value, true AS one_interval FROM events
       WHERE event_type <> 'error' AND user_id IS NOT NULL AND NOT coalesce(value < 0, false)""",
)
def ingest_twice(spark, sf_dir):
    """Files that arrive again open no second interval and close none."""
    history = silver_table(spark, _ingested(spark, sf_dir), EVENT_SPEC).history()
    kept = history.groupBy("event_id", "user_id", "event_type", "value").agg((F.count(F.lit(1)) == 1).alias("one"), F.bool_and(F.col("valid_to").isNull()).alias("open"))
    return kept.select("event_id", "user_id", "event_type", "value", (F.col("one") & F.col("open")).alias("one_interval"))


@query(
    "ingest_quarantine",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
           concat_ws(',', CASE WHEN event_type = 'error' OR event_type IS NULL OR user_id IS NULL THEN 'user_id_missing' END, CASE WHEN value < 0 THEN 'value_negative' END) AS reasons
       FROM events WHERE event_type = 'error' OR event_type IS NULL OR user_id IS NULL OR value < 0""",
)
def ingest_quarantine(spark, sf_dir):
    """Rejected rows of all batches as they arrived, with every reason."""
    layout = Layout(scratch(spark, "event-lake"))
    ingest_bronze(spark, _event_files(spark, sf_dir, "csv"), EVENT_SPEC, layout, scratch(spark, "checkpoint"), files_per_batch=2)
    rejected = spark.read.parquet(layout.errors(EVENT_SPEC.name))
    return rejected.select("event_id", "event_type", F.array_join("reject_reasons", ",").alias("reasons"))


@query(
    "running_sample",
    f"SELECT event_id, event_type, round(sample_score, 9) AS sample_score FROM ({_SAMPLE_SQL})",
)
def running_sample(spark, sf_dir):
    """The sample kept over a stream equals the sample of the whole table."""
    files = _event_files(spark, sf_dir)
    schema = spark.read.parquet(files).schema
    sample = RunningSample(scratch(spark, "running-sample"), "event_type", "event_id", WEIGHTS)
    run_available(raw_stream(spark, files, "parquet", schema, files_per_batch=1), sample.update, scratch(spark, "checkpoint"))
    return sample.result(spark).select("event_id", "event_type", F.round("sample_score", 9).alias("sample_score"))
